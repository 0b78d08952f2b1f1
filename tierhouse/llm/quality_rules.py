"""Quality rules with risk-controlled cutoffs.

Each text is measured once. For every rule a score (higher is worse) falls
into one of a fixed number of bins. Half of the labelled documents proposes
cutoffs: a ladder of levels, each allowing a larger share of good documents
to be rejected. The other half, which had no say in them, certifies the
levels one after the other, most lenient first: the exact binomial
probability of so few false rejections, if the true rate were above `alpha`,
must be at most `delta` divided by the number of strata. The first level that
fails ends the sequence, so no further correction over levels is due, and
each stratum's false rejection rate is at most `alpha`, in all strata at once
with probability 1 - delta. A stratum with too few labels certifies nothing
and keeps whatever passes the base rules.

Defined cases: a null or blank text has no words and fails the base; a null
stratum is a stratum of its own; repeated rows are judged each alike; an
empty table gives an empty result; a text counts once in its stratum, however many
rows, ids and labels it has, with the lowest quality and the highest toxicity,
so copies are neither trials of their own nor in both halves; without labels
only the base rules judge. Other columns of the table are neither read nor confused with
the measures.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import mapped, written

#: Rules, in the order of the `bins` array.
RULES = ("symbols", "duplicate_lines", "repeated_words", "long_words", "capitals", "marks")
N_BINS = 256
#: Shares of good documents that a level may reject in the proposing half.
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.006)
#: A proposed cutoff must reject bad documents this many times as often as good ones.
POWER = 5.0
NEVER = N_BINS + 1
#: Strata whose cutoffs (some 200 bytes each) are sent to every task, 2 MB at most.
BROADCAST_STRATA = 10_000

FIELDS = [
    ("__words", T.LongType()),
    ("__word_chars", T.LongType()),
    ("__symbols", T.LongType()),
    ("__dup_lines", T.LongType()),
    ("__repeat_words", T.LongType()),
    ("__bins", T.ArrayType(T.IntegerType())),
    ("__digest", T.BinaryType()),
]
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
#: White space, and the bytes of UTF-8 that go on with a code point.
_NO_CODE_POINT = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))


def _without(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def _bin(score: float) -> int:
    """Bins about 2 % apart over the useful range; they only have to rise."""
    return min(N_BINS - 1, int(28 * math.log2(1 + 64 * score)))


def measure_text(text: bytes | None) -> tuple[int, int, int, int, int, list[int]]:
    text = text or b""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D only
    n = len(words)
    chars = len(text.translate(None, _NO_CODE_POINT))
    symbols = _without(text, _SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        reach = 0
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    some = max(n, 1)
    upper = _without(text, _CAPITALS)
    scores = (
        symbols / some,
        dup_lines / max(len(lines), 1),
        repeated / some,
        max(0.0, chars / some - 5) / 5,
        upper / max(upper + _without(text, _SMALL), 1),
        _without(text, _MARKS) / some,
    )
    return n, chars, symbols, dup_lines, repeated, [_bin(s) for s in scores]


def _measure(texts: pa.Array) -> list:
    rows = [(*measure_text(t), hashlib.blake2b(t or b"", digest_size=16).digest()) for t in texts.cast(pa.binary()).to_pylist()]
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32()), pa.binary()]
    return [pa.array(c, k) for c, k in zip(columns, kinds)]


def measured(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns of `keep` with the measures of each row's text."""
    return mapped(docs, text, keep, FIELDS, _measure)


def base_failed() -> Column:
    n = F.col("__words")
    return (n < 50) | (100 * F.col("__repeat_words") > 50 * n)


def binomial_at_most(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) for n trials of probability p."""
    if n <= 0:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    if k >= n * p:
        return 1.0  # more than expected: no evidence, whatever the exact value
    total = 0.0
    for i in range(int(k), -1, -1):  # the terms fall, so the rest can be left out once they are lost in the sum
        x = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q
        total += math.exp(x)
        if math.exp(x) < 1e-17 * total:
            break
    return min(1.0, total)


def labelled(measures: DataFrame, labels: DataFrame, doc_id: str, stratum: str) -> DataFrame:
    """Measures of the labelled texts that pass the base rules, once for each stratum: good (1), bad (0), and their half."""
    truth = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("quality").alias("__quality"), F.coalesce(F.max("toxic"), F.lit(0)).alias("__toxic"))
    )
    return (
        measures.where(~base_failed())
        .select(F.col(doc_id).alias("__id"), F.col(stratum).alias("__stratum"), "__bins", "__digest")
        .join(truth, "__id")
        .groupBy("__stratum", "__digest")
        .agg(F.first("__bins").alias("__bins"), F.min("__quality").alias("__quality"), F.max("__toxic").alias("__toxic"))
        .where((F.col("__quality") == 0) | (F.col("__toxic") == 0))
        .select(
            "__stratum",
            "__bins",
            (F.col("__quality") == 1).cast("int").alias("__good"),
            F.pmod(F.xxhash64("__digest"), F.lit(2)).alias("__half"),
        )
    )


def proposed(half: DataFrame) -> DataFrame:
    """For each stratum (`__of`) the cutoffs of every rule and level: `__cuts[rule][level]`."""
    tail = Window.partitionBy("__stratum", "__rule").orderBy(F.desc("__bin"))
    whole = Window.partitionBy("__stratum", "__rule")
    counts = (
        half.select("__stratum", "__good", F.posexplode("__bins").alias("__rule", "__bin"))
        .groupBy("__stratum", "__rule", "__bin")
        .agg(F.sum("__good").alias("__g"), F.sum(1 - F.col("__good")).alias("__b"))
        .withColumns(
            {
                "__tail_g": F.sum("__g").over(tail),
                "__tail_b": F.sum("__b").over(tail),
                "__all_g": F.sum("__g").over(whole),
                "__all_b": F.sum("__b").over(whole),
            }
        )
    )
    useful = (F.col("__tail_b") > 0) & (
        F.col("__tail_b") * F.col("__all_g") >= POWER * F.col("__tail_g") * F.col("__all_b")
    )
    per_level = [
        F.coalesce(
            F.min(F.when(useful & (F.col("__tail_g") <= share * F.col("__all_g")), F.col("__bin"))), F.lit(NEVER)
        )
        for share in LEVELS
    ]
    return (
        counts.groupBy("__stratum", "__rule")
        .agg(F.array(*per_level).alias("__levels"))
        .groupBy("__stratum")
        .agg(F.array_sort(F.collect_list(F.struct("__rule", "__levels"))).alias("__r"))
        .select(F.col("__stratum").alias("__of"), F.col("__r.__levels").alias("__cuts"))
    )


def rejected_at(level: Column) -> Column:
    """Whether some rule's bin reaches its cutoff of that level (counted from 1)."""
    return F.exists(F.arrays_zip("__bins", "__cuts"), lambda z: z["__bins"] >= F.element_at(z["__cuts"], level))


def cutoffs(measures: DataFrame, labels: DataFrame, doc_id: str, stratum: str, alpha: float, delta: float) -> DataFrame:
    """One row for each stratum (`__of`) in which a level is certified: `__cuts` and the `__level`, from 1.

    At alpha = 0.01 that takes some 300 good labelled texts, so there are at most so many such strata.
    """
    known = written(labelled(measures, labels, doc_id, stratum), "quality-labelled")
    cuts = proposed(known.where("__half = 0"))
    strata = max(1, known.select("__stratum").distinct().count())
    levels = F.explode(F.sequence(F.lit(1), F.lit(len(LEVELS))))
    tail = F.udf(lambda k, n: binomial_at_most(k, n, alpha), "double")
    trials = (
        known.where("__half = 1 AND __good = 1")
        .join(cuts, F.col("__stratum").eqNullSafe(F.col("__of")))
        .select("__of", "__bins", "__cuts", levels.alias("__level"))
        .groupBy("__of", "__level")
        .agg(F.sum(rejected_at(F.col("__level")).cast("long")).alias("__k"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__fails", tail("__k", "__n") > delta / strata)
        .groupBy(F.col("__of").alias("__tried"))
        .agg(F.coalesce(F.min(F.when(F.col("__fails"), F.col("__level"))) - 1, F.lit(len(LEVELS))).alias("__level"))
    )
    certified = cuts.join(trials, F.col("__of").eqNullSafe(F.col("__tried"))).where("__level > 0")
    return written(certified.select("__of", "__cuts", "__level"), "quality-cuts")


def judged(measures: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    """The measures with `__failed` (base) and `__kept`.

    Strata are few and their rows short, so these are sent to all tasks and no
    row moves by its stratum; beyond BROADCAST_STRATA they are joined by it.
    """
    verdict = F.coalesce(rejected_at(F.col("__level")), F.lit(False))
    few = F.broadcast(cuts) if cuts.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA else cuts
    return (
        measures.join(few, F.col(stratum).eqNullSafe(F.col("__of")), "left")
        .withColumn("__failed", base_failed())
        .withColumn("__kept", ~F.col("__failed") & ~verdict)
    )


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    alpha: float = 0.01,
    delta: float = 0.05,
) -> DataFrame:
    """Per row: id, measures, base_failed, kept, and the certified level of its stratum."""
    measures = written(measured(docs, text, [doc_id, stratum]), "quality-measures")
    rows = judged(measures, cutoffs(measures, labels, doc_id, stratum, alpha, delta), stratum)
    return rows.select(
        F.col(doc_id).alias("doc_id"),
        F.col("__words").alias("n_words"),
        F.col("__word_chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        F.col("__dup_lines").alias("n_dup_lines"),
        F.col("__repeat_words").alias("n_repeat_words"),
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
        F.coalesce(F.col("__level"), F.lit(0)).alias("level"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    alpha: float = 0.01,
    delta: float = 0.05,
) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    The texts are measured a second time for the filter, which is cheaper than
    moving or writing them.
    """
    measures = written(measured(docs, text, [doc_id, stratum]), "quality-measures")
    cuts = cutoffs(measures, labels, doc_id, stratum, alpha, delta)
    return judged(measured(docs, text, docs.columns), cuts, stratum).where("__kept").select(*docs.columns)
