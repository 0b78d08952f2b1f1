"""Document quality by hierarchical empirical Bayes.

A classifier gives each document a probability of being good and one of being
toxic, from its hashed words and the rule scores of its text. Sites add what
documents of the same host and path are like: grouped sums of the documents'
probabilities give each host a posterior mean that is shrunk towards the
global mean, and each path one that is shrunk towards its host's; how strongly
follows from the spread between hosts and between paths (moments). A
document's own share is taken out of its path before the two are combined on
the scale of log odds, so no evidence counts twice. Sparse sites thus fall
back to their host, and sparse hosts to the whole table.

The classifier learns from about `sample` labelled documents at most, chosen by
a hash of their ids, one row for each; everything else covers all documents.
It is fitted once for each fold of the texts, on the others' texts, and a
document is scored by its own fold's: none is scored by a classifier that has
learnt from its text, so the sites' sums are not made of fitted labels either.

Defined cases: a null text has no words and is scored as such; null hosts and
paths are sites of their own; repeated rows count each; an empty table gives
an empty result; labels that repeat an id count once (lower quality, higher
toxicity), and of a labelled id's rows one text is learnt from, that of the
least digest, so repeated rows change nothing and reruns agree; without labels every probability is one half and nothing is
dropped.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import mapped, uniform, words_of, written
from tierhouse.llm.quality_rules import N_BINS, RULES, measure_text

WORD_SLOTS = 1 << 15
#: Words, and a slot for each rule and step of its score.
STEPS = 16
SLOTS = WORD_SLOTS + len(RULES) * STEPS
HEADS = ("good", "toxic")
FOLDS = 2
#: Up to this sample the chosen ids (some 32 bytes each) are sent to every task, 32 MB at most.
BROADCAST_SAMPLE = 1_000_000


def digest_of(text: bytes | None) -> bytes:
    return hashlib.blake2b(text or b"", digest_size=16).digest()


def fold_of(digest: bytes) -> int:
    return digest[0] % FOLDS


def features(texts: list[bytes | None]) -> list[np.ndarray]:
    """The slots that each text fills."""
    words = words_of(texts, lower=True)
    slots = (words.hashes >> np.uint64(64 - 15)).astype(np.int32)
    out = []
    for i, text in enumerate(texts):
        bins = measure_text(text)[5]
        rules = [WORD_SLOTS + r * STEPS + b * STEPS // N_BINS for r, b in enumerate(bins)]
        out.append(np.append(np.unique(slots[words.first[i] : words.first[i + 1]]), np.array(rules, np.int32)).astype(np.int32))
    return out


@dataclass
class Head:
    weights: np.ndarray
    bias: float


def fit_head(rows: list[np.ndarray], truth: np.ndarray, steps: int = 250) -> Head:
    """Logistic regression on the slots that differ between the classes by three standard errors."""
    n, ones = len(rows), int(truth.sum())
    if not 0 < ones < n:
        return Head(np.zeros(SLOTS), 0.0 if not n else float(np.log((ones + 0.5) / (n - ones + 0.5))))
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    slot = np.concatenate(rows)
    with_1 = np.bincount(slot, truth[owner], SLOTS)
    all_ = np.bincount(slot, minlength=SLOTS)
    share_1, share_0, share = with_1 / ones, (all_ - with_1) / (n - ones), (all_ + 0.5) / (n + 1)
    z = (share_1 - share_0) / np.sqrt(share * (1 - share) * (1 / ones + 1 / (n - ones)))
    use = np.abs(z) >= 3
    mine = use[slot]
    owner, slot = owner[mine], slot[mine]
    weights, bias = np.zeros(SLOTS), float(np.log(ones / (n - ones)))
    m, v = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for t in range(1, steps + 1):  # Adam over the whole sample
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights[slot], n) + bias, -30, 30)))
        error = (p - truth) / n
        grad = np.append(np.bincount(slot, error[owner], SLOTS) + 1e-4 * weights, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        weights, bias = weights - step[:-1], bias - step[-1]
    return Head(np.where(use, weights, 0.0), bias)


def _packed(slots: np.ndarray) -> bytes:
    """A document's slots as compressed bits: some 4 KB at most, however long its text."""
    bits = np.zeros(SLOTS, bool)
    bits[slots] = True
    return zlib.compress(np.packbits(bits).tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=SLOTS)).astype(np.int32)


def learnt_from(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, sample: int) -> DataFrame:
    """One row for each chosen labelled id, in order of the ids: __quality, __toxic, __digest and __slots."""
    truth = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("quality").alias("__quality"), F.coalesce(F.max("toxic"), F.lit(0)).alias("__toxic"))
    )
    share = sample / max(1, truth.count())
    chosen = truth.where(uniform(F.col("__id"), F.lit(11)) < share)
    few = F.broadcast(chosen) if sample <= BROADCAST_SAMPLE else chosen
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__body")).join(few, "__id")

    def measure(texts: pa.Array) -> list:
        bodies = texts.cast(pa.binary()).to_pylist()
        return [pa.array([digest_of(t) for t in bodies], pa.binary()), pa.array(map(_packed, features(bodies)), pa.binary())]

    fields = [("__digest", T.BinaryType()), ("__slots", T.BinaryType())]
    made = mapped(rows, "__body", ["__id", "__quality", "__toxic"], fields, measure)
    first = F.min(F.struct("__digest", "__slots")).alias("__text")
    return (
        made.groupBy("__id", "__quality", "__toxic").agg(first).orderBy("__id")
        .select("__quality", "__toxic", "__text.__digest", "__text.__slots")
    )


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, sample: int) -> list[list[Head]]:
    """For each fold the heads that are fitted on the texts of the others."""
    got = learnt_from(docs, labels, doc_id, text, sample).toArrow().to_pydict()  # `sample` rows of 4 KB at most
    slots = [_unpacked(b) for b in got["__slots"]]
    folds = np.array([fold_of(d) for d in got["__digest"]], int)
    truths = [np.array(got[c], float) for c in ("__quality", "__toxic")]
    out = []
    for fold in range(FOLDS):
        use = np.flatnonzero(folds != fold)
        out.append([fit_head([slots[i] for i in use], truth[use]) for truth in truths])
    return out


def scored(docs: DataFrame, heads: list[list[Head]], text: str, keep: list[str]) -> DataFrame:
    """`keep` and the probability of each head, by the classifier of the text's fold."""

    def measure(texts: pa.Array) -> list:
        bodies = texts.cast(pa.binary()).to_pylist()
        rows = features(bodies)
        mine = [heads[fold_of(digest_of(t))] for t in bodies]
        logits = [[float(own[h].weights[r].sum() + own[h].bias) for own, r in zip(mine, rows)] for h in range(len(HEADS))]
        return [pa.array(1 / (1 + np.exp(-np.clip(np.array(x, float), -20, 20)))) for x in logits]

    return mapped(docs, text, keep, [(f"__{h}", T.DoubleType()) for h in HEADS], measure)


def _log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))


def spread(sites: DataFrame, n: Column, total: Column, squares: Column, centre: Column) -> float:
    """Prior strength by moments: how many documents a parent's mean is worth to a child."""
    rate = total / n
    within = F.greatest(squares / n - rate * rate, F.lit(0.0))
    row = sites.agg(
        F.sum(n).alias("n"),
        F.sum(n * (rate - centre) ** 2).alias("between"),
        F.sum(within).alias("noise"),
        (F.sum(n * centre * (1 - centre)) / F.sum(n)).alias("whole"),
    ).first()
    if not row.n:
        return 1.0
    between = (row.between - row.noise) / row.n
    return float(min(1e6, max(1.0, row.whole / between - 1))) if between > 0 else 1e6


def with_sites(rows: DataFrame, host: str, path: str) -> DataFrame:
    """The rows and, for each head, `__<head>_site` (prior without the row itself) and `__<head>_mean`."""
    sums = {"__n": F.count(F.lit(1))}
    for h in HEADS:
        sums |= {f"__{h}_s": F.sum(f"__{h}"), f"__{h}_q": F.sum(F.col(f"__{h}") ** 2)}
    paths = written(rows.groupBy(F.col(host).alias("__h"), F.col(path).alias("__p")).agg(*(c.alias(k) for k, c in sums.items())), "quality-paths")
    columns = ["__n", *(f"__{h}_{x}" for h in HEADS for x in "sq")]
    hosts = paths.groupBy(F.col("__h").alias("__host")).agg(*(F.sum(c).alias("__h" + c) for c in columns))
    whole = paths.agg(*(F.sum(c).alias(c) for c in columns)).first()
    tree = paths.join(hosts, F.col("__h").eqNullSafe(F.col("__host"))).drop("__host")
    made, means = {}, {}
    for h in HEADS:
        mean = min(1 - 1e-6, max(1e-6, (whole[f"__{h}_s"] or 0.0) / (whole["__n"] or 1)))
        col = lambda x, h=h: F.col(f"__{h}_{x}")
        up = lambda x, h=h: F.col(f"__h__{h}_{x}")
        k_host = spread(hosts, F.col("__h__n"), up("s"), up("q"), F.lit(mean))
        host_mean = (up("s") + k_host * mean) / (F.col("__h__n") + k_host)
        k_path = spread(tree, F.col("__n"), col("s"), col("q"), host_mean)
        made |= {f"__{h}_host": host_mean, f"__{h}_k": F.lit(k_path)}
        means[f"__{h}_mean"] = F.lit(mean)
    sites = tree.withColumns(made).select("__h", "__p", "__n", *(f"__{h}_{x}" for h in HEADS for x in ("s", "host", "k")))
    joined = rows.join(sites, F.col(host).eqNullSafe(F.col("__h")) & F.col(path).eqNullSafe(F.col("__p")), "left")
    others = {
        f"__{h}_site": (F.col(f"__{h}_s") - F.col(f"__{h}") + F.col(f"__{h}_k") * F.col(f"__{h}_host"))
        / (F.col("__n") - 1 + F.col(f"__{h}_k"))
        for h in HEADS
    }
    return joined.withColumns(others | means)


def combined(head: str) -> Column:
    """The document's probability with its site's prior in place of the global one."""
    logit = (
        _log_odds(_clipped(F.col(f"__{head}")))
        - _log_odds(_clipped(F.col(f"__{head}_mean")))
        + _log_odds(_clipped(F.col(f"__{head}_site")))
    )
    return 1 / (1 + F.exp(-logit))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 8000,
    cutoff: float = 0.5,
) -> DataFrame:
    """Per row: the classifier's, the site's and the combined probabilities, and `kept`.

    The given table has no url: by default its source stands for the host and its lang for the path.
    """
    heads = train(docs, labels, doc_id, text, sample)
    rows = written(scored(docs, heads, text, [doc_id, host, path]), "quality-scores")
    rows = with_sites(rows, host, path).withColumns({f"__{h}_all": combined(h) for h in HEADS})
    out = [F.col(doc_id).alias("doc_id")]
    for h in HEADS:
        out += [
            F.col(f"__{h}").alias(f"p_{h}_document"),
            F.col(f"__{h}_site").alias(f"p_{h}_site"),
            F.col(f"__{h}_all").alias(f"p_{h}"),
        ]
    kept = (F.col("__good_all") >= cutoff) & (F.col("__toxic_all") <= cutoff)
    return rows.select(*out, (F.col("__toxic_all") > cutoff).alias("is_toxic"), kept.alias("kept"))
