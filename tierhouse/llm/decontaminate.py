"""Benchmark decontamination by winnowing.

Of every `WINDOW` consecutive hashes of `GRAM`-word grams the smallest is a
fingerprint. Two texts that share GRAM + WINDOW - 1 = 10 words share such a
window, hence its fingerprint, so joining fingerprints of documents and
benchmark windows finds every shared span of ten words. A window has its
fingerprint at one of six offsets, so each hit gives at most six places of the
document, however many items have that fingerprint. The words of these places
are joined with the distinct windows of the benchmark; windows that overlap
extend a hit. Items of fewer than ten words are one window, found by a gram of
their own length, for the lengths that occur. Windows of the same items form a
class, and documents that hit the same classes form a set: items are listed
once for each set, so n documents and n items with one passage in common make n
and n rows, not n times n. Only DataFrame functions are used.

Defined cases: null text has no words; a document or item without words meets
nothing; a short item is one window; an item that repeats counts once by its
id; repeated document rows get a row each; an empty table gives an empty
result (an empty benchmark: nothing is contaminated). Other columns are kept
by `without_contaminated` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.llm.common import written

GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
#: Keys (64 bits each) of documents with a common fingerprint that are broadcast; more are joined by a shuffle.
FEW_KEYS = 1_000_000
#: Fixed value: what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """A-Z lower-cased, then the runs of letters, digits and what lies beyond ASCII."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once; a plain alias could be copied into every step of a loop."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _places(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _grams(tokens: Column, n: int) -> Column:
    """The hash of each run of n words."""
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    at = lambda h: F.transform(
        _places(F.size(h) - n + 1), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n)))
    )
    return _bound(hashed, at)


def _selected(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """key, pos (from 0) and fp of every gram that is the smallest of some window."""

    def lows(grams: Column) -> Column:
        return F.transform(
            _places(F.size(grams) - WINDOW + 1), lambda i: F.least(*(F.get(grams, i + k) for k in range(WINDOW)))
        )

    def chosen(grams: Column, low: Column) -> Column:
        # A gram is chosen if the largest of its windows' minima is itself.
        top = lambda i: F.greatest(*(F.get(low, i - k) for k in range(WINDOW)))
        marked = F.transform(grams, lambda h, i: F.when(top(i) == h, F.struct(i.alias("pos"), h.alias("fp"))))
        return F.filter(marked, lambda s: s.isNotNull())

    picked = _bound(_grams(tokens, GRAM), lambda g: _bound(lows(g), lambda low: chosen(g, low)))
    return df.select(key, F.explode(picked).alias("s")).select(key, "s.pos", "s.fp")


def _of_length(df: DataFrame, key: str, tokens: Column, n: int) -> DataFrame:
    """key, pos and fp of every run of n words."""
    return df.select(key, F.posexplode(_grams(tokens, n)).alias("pos", "fp"))


def _windows(items: DataFrame) -> DataFrame:
    """item_id and __window (words joined by spaces, which no word has): each window of an item once."""
    item = F.col("__item")
    cut = F.transform(_places(F.size(item) - SPAN + 1), lambda i: F.array_join(F.slice(item, i + 1, SPAN), " "))
    own = F.when(F.size(item) >= SPAN, cut).otherwise(F.array(F.array_join(item, " ")))
    return items.where(F.size("__item") > 0).select("item_id", F.explode(own).alias("__window")).distinct()


def _classed(windows: DataFrame) -> DataFrame:
    """Distinct windows with __class, equal for windows of the same items (128 bits and the number of items)."""
    hashed = lambda seed: F.hex(F.bit_xor(F.xxhash64("item_id", F.col("item_id").isNull(), F.lit(seed))))
    return windows.groupBy("__window").agg(F.concat_ws(":", F.count(F.lit(1)), hashed(1), hashed(2)).alias("__class"))


def _candidates(docs: DataFrame, classed: DataFrame) -> DataFrame:
    """__key and __places, the (start, n) in a document where a window of n words can be; at most one for each word and n."""
    parts = classed.select(F.split("__window", " ").alias("__words"))
    tokens = words(F.col("__text"))

    def offset(grams: Column) -> Column:
        low = F.array_min(grams)
        return F.struct(low.alias("low"), (F.array_position(grams, low) - 1).cast("int").alias("offset"))

    long_ = parts.where(F.size("__words") == SPAN).select(_bound(_grams(F.col("__words"), GRAM), offset).alias("w"))
    met = _met(_selected(docs, "__key", tokens), long_.select(F.col("w.low").alias("low"), F.col("w.offset").alias("offset")), SPAN)
    # At most nine lengths, whatever the benchmark's size.
    short = sorted(r.n for r in parts.select(F.size("__words").alias("n")).where(F.col("n") < SPAN).distinct().collect())
    for n in short:
        own = parts.where(F.size("__words") == n).select(F.element_at(_grams(F.col("__words"), n), 1).alias("low"), F.lit(0).alias("offset"))
        met = met.unionByName(_met(_of_length(docs, "__key", tokens, n), own, n))
    return written(met.groupBy("__key").agg(F.collect_set(F.struct("start", "n")).alias("__places")), "winnow-places")


def _met(left: DataFrame, right: DataFrame, n: int) -> DataFrame:
    return left.join(right.distinct(), F.col("fp") == F.col("low")).select("__key", (F.col("pos") - F.col("offset")).alias("start"), F.lit(n).alias("n"))


def hits(docs: DataFrame, classed: DataFrame) -> DataFrame:
    """(__key, first, last, __class) of every place of a document where a window of `classed` occurs.

    `docs` has __key and __text, `classed` is as of `_classed`.
    """
    places = _candidates(docs, classed)
    keys = places.select("__key")
    few = keys.count() <= FEW_KEYS
    # Texts without a hit need not move: the keys are broadcast while they are few, else joined by a shuffle.
    near = docs.join(F.broadcast(keys) if few else keys, "__key", "left_semi")

    def spans(tokens: Column) -> Column:
        fits = F.filter("__places", lambda p: (p["start"] >= 0) & (p["start"] + p["n"] <= F.size(tokens)))
        return F.transform(
            fits,
            lambda p: F.struct(
                p["start"].alias("first"),
                (p["start"] + p["n"] - 1).alias("last"),
                F.array_join(F.slice(tokens, p["start"] + 1, p["n"]), " ").alias("words"),
            ),
        )

    placed = near.join(places, "__key").select("__key", F.explode(_bound(words(F.col("__text")), spans)).alias("s"))
    return placed.join(classed, F.col("s.words") == F.col("__window")).select("__key", "s.first", "s.last", "__class")


def contamination(docs: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Per key with a hit: n_hit, n_items, items_sha256, and item_ids (sorted strings; an item without id counts but is not listed).

    `docs` has `key` and __text; rows of one key are the same. `items` has item_id and __item (words).
    """
    docs = docs.withColumnRenamed(key, "__key")
    windows = written(_windows(items), "winnow-windows")
    classed = written(_classed(windows), "winnow-classes")
    # The words of a document that lie in some window: spans in order, each counted beyond the reach of those before.
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("first", "last"))),
        F.struct(F.lit(-1).alias("reach"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["reach"], x["last"]).alias("reach"),
            (s["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(s["reach"] + 1, x["first"]) + 1)).alias("n"),
        ),
        lambda s: s["n"],
    )
    found = hits(docs, classed).groupBy("__key").agg(covered.alias("n_hit"), F.array_sort(F.collect_set("__class")).alias("__classes"))
    found = written(found.withColumn("__set", F.sha2(F.array_join("__classes", ","), 256)), "winnow-found")
    # A class's items are those of any of its windows.
    members = windows.join(classed.groupBy("__class").agg(F.min("__window").alias("__window")), "__window").select("__class", "item_id")
    sets = found.groupBy("__set").agg(F.first("__classes").alias("__classes")).select("__set", F.explode("__classes").alias("__class"))
    listed = (
        sets.join(members, "__class")
        .groupBy("__set")
        .agg(
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
            F.max(F.col("item_id").isNull().cast("int")).alias("nameless"),
        )
        .select(
            "__set",
            "item_ids",
            (F.size("item_ids") + F.col("nameless")).cast("long").alias("n_items"),
            F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        )
    )
    return found.join(listed, "__set").select(F.col("__key").alias(key), "n_hit", "n_items", "items_sha256", "item_ids")


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("__item"))


def _row_key(doc_id: str, text: str) -> Column:
    """Rows that agree in id and text are one document."""
    return F.xxhash64(F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit(""))))


def contaminated_rows(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(F.col(doc_id).alias("__doc"), _row_key(doc_id, text).alias("__k"), F.col(text).alias("__text"))
    found = contamination(rows.select("__k", "__text"), _items(benchmark, item_id, item_text), "__k").drop("item_ids")
    out = rows.select("__doc", "__k", F.size(words(F.col("__text"))).cast("long").alias("n_words")).join(found, "__k", "left")
    return out.select(
        F.col("__doc").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows that share no window with the benchmark, with all their columns."""
    rows = docs.select(_row_key(doc_id, text).alias("__k"), F.col(text).alias("__text"))
    found = contamination(rows, _items(benchmark, item_id, item_text), "__k").select("__k")
    return docs.join(found, _row_key(doc_id, text) == F.col("__k"), "left_anti")
