"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due the same number of copies, target / size of
the source: a whole part and a fraction. The fractions are rounded to 0 or 1
by pivoting: of two documents, words move at random from one to the other
until one of them is due a whole copy; the draw is fair, so that each document
keeps its expectation, and the words due together stay the same. What is left
over, one document that is still fractional, meets the next. Blocks of
documents, dealt by a hash, are folded largest first, so that large documents
are settled while small ones can still make up for them; the leftovers of the
blocks are blocks of the next level, up to one document for each source,
which is rounded to the nearest. A source thus misses its target by half a
(usually small) document at most. Only DataFrame functions are used.

Rows that agree in id, source and size are interchangeable and of one size, so
moving words among them comes to this: as many of them as are due together
get a copy, and one is left with the fraction that remains. Only that one meets
other documents. Such rows are a count until the result is made, however many
they are.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a
source, ordered last; an empty source (size 0) has target 0; repeated rows
count each; equal sizes are ordered by hash and id; an empty table gives an
empty result. Other columns pass through `mixed` untouched. The draws are
hashes of ids, so a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.llm.common import uniform, written
from tierhouse.operators.ordered import dense_number
from tierhouse.operators.rows import explode_range

#: Documents folded together; the leftovers of so many blocks make a block of the next level.
BLOCK = 100
WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3.0


def word_count(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null has none."""
    spaces = "\\x20\\x09-\\x0D"
    # Each word keeps one letter, so nothing is cut out or collected.
    return F.coalesce(
        F.length(F.regexp_replace(F.regexp_replace(text, f"[^{spaces}]+", "w"), f"[{spaces}]+", "")).cast("long"), F.lit(0).cast("long")
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source (`__source`): its size, weight, and target after capping; `sizes` has `__rows` rows of `__size` words each.

    Works on one row for each source. The excess of capped sources goes to the
    others by weight, again until no source is above its cap; each pass caps
    at least one more source, and the driver sees two numbers of it.
    """
    sources = sizes.groupBy("__source").agg(F.sum(F.col("__size") * F.col("__rows")).alias("__source_size"))
    numbered = written(
        dense_number(sources, [F.col("__source").isNull(), F.col("__source")], "__rank"), "mixing-sources"
    ).withColumn("__weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("__rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    cap = MOST_COPIES * F.col("__source_size")
    whole = numbered.agg(F.sum("__source_size").alias("n")).first().n or 0
    level = None  # words for one unit of weight among the sources that are not capped
    while True:
        open_ = F.lit(True) if level is None else F.col("__weight") * level <= cap
        row = numbered.agg(
            F.sum(F.when(open_, F.col("__weight"))).alias("w"), F.sum(F.when(open_, F.lit(0.0)).otherwise(cap)).alias("c")
        ).first()
        if not row.w or (new := (whole - row.c) / row.w) == level:
            break
        level = new
    target = F.least(cap, F.col("__weight") * F.lit(0.0 if level is None else level))
    return numbered.select("__source", "__source_size", "__weight", target.cast("double").alias("__target"))


def _pivot(state: Column, item: Column) -> Column:
    """One step of the fold: the carried document `c` meets the next one."""
    c, f, x = state["c"], state["c"]["frac"], item["frac"]
    a, b = item["size"].cast("double"), state["c"]["size"].cast("double")
    up = F.least(x * a, (1 - f) * b)  # words that can move from the next to the carried one
    down = F.least(f * b, (1 - x) * a)
    rises = item["draw"] * (up + down) < down
    # After the move one of the two is due 0 or 1.
    settles_item = F.when(rises, x * a <= (1 - f) * b).otherwise((1 - x) * a <= f * b)
    moved = F.when(rises, up).otherwise(-down)
    done_item = F.when(rises, F.lit(0)).otherwise(F.lit(1))
    left_c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), f + moved / b))
    left_x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x - moved / a))
    with_frac = lambda d, v: d.withField("frac", v)
    settled = F.when(settles_item, _decided(item, done_item)).otherwise(_decided(c, 1 - done_item))
    carried = F.when(settles_item, with_frac(c, left_c)).otherwise(with_frac(item, left_x))
    return F.when(c.isNull(), F.struct(item.alias("c"), state["out"].alias("out"))).otherwise(
        F.struct(carried.alias("c"), F.concat(state["out"], F.array(settled)).alias("out"))
    )


def _decided(document: Column, copies: Column) -> Column:
    return F.struct(document["row"].alias("row"), copies.cast("int").alias("extra"))


def _fold(items: Column, item_type: str, row_type: str) -> Column:
    start = F.struct(
        F.lit(None).cast(item_type).alias("c"), F.array().cast(f"array<struct<row:{row_type},extra:int>>").alias("out")
    )
    return F.aggregate(items, start, _pivot)


def rounded(rows: DataFrame, most: int) -> DataFrame:
    """`__row` and `__extra` (0 or 1) for rows with `__source`, `__size`, `__frac`, `__id` and a struct `__row`.

    `most` is the number of rows of the largest source.
    """
    row_type = rows.schema["__row"].dataType.simpleString()
    done, level = [], 0
    whole = (F.col("__frac") <= 0) | (F.col("__frac") >= 1) | (F.col("__size") <= 0)
    done.append(rows.where(whole).select("__row", F.round("__frac").cast("int").alias("__extra")))
    left = rows.where(~whole)
    while True:
        blocks = -(-most // BLOCK)
        # Blocks are dealt by id and size, in which no two rows of a source agree.
        block = F.pmod(F.xxhash64("__id", "__size", F.lit(level)), F.lit(blocks))
        item = F.struct(
            (-F.col("__size")).alias("order"),
            F.xxhash64("__id", F.lit(level)).alias("tie"),
            F.col("__size").alias("size"),
            F.col("__frac").alias("frac"),
            uniform(F.col("__id"), F.lit(1000 + level)).alias("draw"),
            F.col("__id").alias("id"),
            F.col("__row").alias("row"),
        )
        grouped = left.groupBy("__source", block.alias("__block")).agg(F.array_sort(F.collect_list(item)).alias("items"))
        item_type = grouped.schema["items"].dataType.elementType.simpleString()
        folded = written(grouped.select("__source", _fold(F.col("items"), item_type, row_type).alias("f")), f"mixing-level{level}")
        done.append(folded.select(F.explode("f.out").alias("o")).select(F.col("o.row").alias("__row"), F.col("o.extra").alias("__extra")))
        left = folded.select(
            "__source",
            F.col("f.c.size").alias("__size"),
            F.col("f.c.frac").alias("__frac"),
            F.col("f.c.id").alias("__id"),
            F.col("f.c.row").alias("__row"),
        )
        if blocks == 1:
            break
        most, level = blocks, level + 1
    last = F.col("__frac") >= 0.5  # to the nearest: one document of each source, so that the source comes near its target
    done.append(left.select("__row", last.cast("int").alias("__extra")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _classes(docs: DataFrame, doc_id: str, text: str, source: str) -> tuple[DataFrame, bool]:
    """A row for the rows of docs that agree in id, source and size, and whether any do.

    `rows` is their number; each is taken `whole` times, and `extra` of them
    once more.
    """
    sizes = written(
        docs.select(
            F.col(doc_id).alias("__id"), F.col(source).cast("string").alias("__source"), word_count(F.col(text)).alias("__size")
        )
        .groupBy("__id", "__source", "__size")
        .agg(F.count(F.lit(1)).alias("__rows")),
        "mixing-sizes",
    )
    targets = source_targets(sizes).withColumnRenamed("__source", "__of")
    due = sizes.join(targets, F.col("__source").eqNullSafe(F.col("__of")))
    rate = F.when(F.col("__source_size") > 0, F.least(F.lit(MOST_COPIES), F.col("__target") / F.col("__source_size"))).otherwise(0.0)
    together = F.col("__rows") * (F.col("__rate") - F.floor("__rate"))
    settled = F.least(F.floor(together), F.col("__rows") - 1)
    rows = due.withColumn("__rate", rate).select(
        "__source",
        "__size",
        "__id",
        (together - settled).alias("__frac"),
        F.struct(
            F.col("__id").alias("doc_id"),
            F.col("__source").alias("source"),
            F.col("__size").alias("size"),
            F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"),
            F.col("__rows").alias("rows"),
            F.floor("__rate").cast("int").alias("whole"),
            settled.alias("settled"),
        ).alias("__row"),
    )
    counts = sizes.groupBy("__source").agg(F.count(F.lit(1)).alias("n"), F.max("__rows").alias("m"))
    most = counts.agg(F.max("n").alias("n"), F.max("m").alias("m")).first()
    out = rounded(rows, most.n or 1)
    fields = [F.col(f"__row.{c}").alias(c) for c in ("doc_id", "source", "size", "source_size", "target", "rows", "whole")]
    return out.select(*fields, (F.col("__row.settled") + F.col("__extra")).alias("extra")), (most.m or 1) > 1


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: doc_id, source, size, source_size, target and copies; taken = copies * size."""
    classes, repeats = _classes(docs, doc_id, text, source)
    place = F.lit(1)
    if repeats:
        classes, place = explode_range(written(classes, "mixing-classes"), F.lit(1), F.col("rows"), 1, "__place"), F.col("__place")
    copies = F.col("whole") + (place <= F.col("extra")).cast("int")
    return classes.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies").cast("long") * F.col("size")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of `docs` with all their columns, each as often as it is taken, and `copy` from 1.

    If the table has a column of that name, the number's gets a line below after it (`copy_`).
    """
    number, taken_names = "copy", {c.lower() for c in docs.columns}
    while number in taken_names:
        number += "_"
    classes, repeats = _classes(docs, doc_id, text, source)
    key = lambda i, s, n: F.xxhash64(i, s, n)
    due = written(
        classes.select(
            key("doc_id", "source", "size").alias("__key"),
            F.col("doc_id").alias("__i"),
            F.col("source").alias("__s"),
            F.col("size").alias("__n"),
            F.col("whole").alias("__whole"),
            F.col("extra").alias("__extra"),
            ((F.col("extra") > 0) & (F.col("extra") < F.col("rows"))).alias("__divided"),
        ),
        "mixing-taken",
    )
    own = {"__src": F.col(source).cast("string"), "__len": word_count(F.col(text))}
    rows = docs.select(
        F.struct(*docs.columns).alias("__row"), F.col(doc_id).alias("__id"), F.xxhash64(F.col(text)).alias("__hash"), *(c.alias(k) for k, c in own.items())
    ).withColumn("__own", key("__id", "__src", "__len"))
    joined = rows.join(
        due,
        (F.col("__own") == F.col("__key"))
        & F.col("__id").eqNullSafe(F.col("__i"))
        & F.col("__src").eqNullSafe(F.col("__s"))
        & (F.col("__len") == F.col("__n")),
    )
    taken = joined.select("__row", (F.col("__whole") + (F.col("__extra") > 0).cast("int")).alias("__copies"), "__divided")
    if repeats and not due.where("__divided").isEmpty():
        taken = taken.where("NOT __divided").unionByName(_shared_out(joined.where("__divided")))
    times = F.when(F.col("__copies") > 0, F.sequence(F.lit(1), F.col("__copies"))).otherwise(F.array().cast("array<int>"))
    return taken.select("__row", F.explode(times).alias("__copy")).select("__row.*", F.col("__copy").alias(number))


def _shared_out(rows: DataFrame) -> DataFrame:
    """Rows of classes of which some get one copy more: the first ones by the hash of their text.

    They are numbered in range partitions, and a draw parts equal texts, so no class is one task's.
    """
    same = ["__own", "__id", "__src", "__len"]
    numbered = written(dense_number(rows, [*same, "__hash", F.rand(1)], "__at"), "mixing-shared")
    first = numbered.groupBy(*same).agg(F.min("__at").alias("__first"))
    first = first.select(*(F.col(c).alias(f"{c}_of") for c in same), "__first")
    of_class = F.lit(True)
    for c in same:
        of_class = of_class & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    more = F.col("__at") - F.col("__first") < F.col("__extra")
    return numbered.join(first, of_class).select("__row", (F.col("__whole") + more.cast("int")).alias("__copies"), "__divided")
