"""Importance resampling toward a target: hashed features, log-ratio weights, Gumbel draws.

Features are runs of words; a feature's bucket is the CRC-32 of its bytes,
modulo the number of buckets. CRCs are made of length-bucketed matrices: the
distinct features of a slice are grouped by length into two-dimensional byte
arrays, all CRCs of a length advance together, one column of bytes after the
other, and the buckets are scattered back to the places of the features.

Both tables are counted in one pass each, pre-aggregated in the tasks to at
most one row for each bucket. The gains (one number for each bucket) are the
only thing that reaches the driver; its size is the parameter `buckets`. A
second pass over the texts sums the gains; only ids and numbers are ranked.

Defined cases: a null text has no words, hence no features and weight 0; a row
is a document, also if its id repeats; an id of null is an empty string in the
key of its draw, and comes last among equal scores; rows that agree in score
and id are ranked by weight, then by features; empty tables give an empty
result or count as zero features. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import CHUNK_BYTES, in_tasks, mapped, shards_of, written
from tierhouse.operators.ordered import dense_number

#: The reflected polynomial of CRC-32, a fixed value.
_POLYNOMIAL = np.uint32(0xEDB88320)
_START = np.uint32(0xFFFFFFFF)
#: Columns of a matrix; a longer feature is cut into rows of as many bytes.
_COLUMNS = 64

_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[0x80:] = True


def _table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & np.uint32(1), (crc >> np.uint32(1)) ^ _POLYNOMIAL, crc >> np.uint32(1))
    return crc


_STEP = _table()


def _advance(crc: np.ndarray, column: np.ndarray | np.uint32) -> np.ndarray:
    """All registers, moved on by one byte each."""
    return (crc >> np.uint32(8)) ^ _STEP[(crc ^ column) & np.uint32(255)]


def _by_column(columns: np.ndarray, start: np.uint32) -> np.ndarray:
    """The registers after a matrix whose first axis is the place in the feature."""
    crc = np.full(columns.shape[1], start, np.uint32)
    for column in columns:
        crc = _advance(crc, column)
    return crc


def _over_zeros() -> list[list[int]]:
    """What _COLUMNS zero bytes make of a register, by the value of each of its bytes."""
    lanes = []
    for lane in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * lane)
        for _ in range(_COLUMNS):
            crc = _advance(crc, np.uint32(0))
        lanes.append(crc.tolist())
    return lanes


_ZEROS = _over_zeros()


def _long_crc(feature: np.ndarray) -> int:
    """The register after a feature of more than _COLUMNS bytes: its full rows as one matrix, then joined in order."""
    head = len(feature) % _COLUMNS
    crc = int(_by_column(feature[:head, None], _START)[0])
    for row in _by_column(feature[head:].reshape(-1, _COLUMNS).T, np.uint32(0)).tolist():
        crc = _ZEROS[0][crc & 255] ^ _ZEROS[1][crc >> 8 & 255] ^ _ZEROS[2][crc >> 16 & 255] ^ _ZEROS[3][crc >> 24] ^ row
    return crc


def crc32s(features: pa.Array) -> np.ndarray:
    """The CRC-32 of each value of a binary array without nulls."""
    n = len(features)
    if not n:
        return np.zeros(0, np.uint32)
    _, offsets, values = features.cast(pa.large_binary()).buffers()
    at = np.frombuffer(offsets, np.int64)[features.offset : features.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    lengths = np.diff(at)
    order = np.argsort(lengths, kind="stable")
    out = np.empty(n, np.uint32)
    borders = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for rows in np.split(order, borders[1:]):
        length = int(lengths[rows[0]])
        if length <= _COLUMNS:
            out[rows] = _by_column(data[at[rows] + np.arange(length)[:, None]], _START)
        else:
            out[rows] = [_long_crc(data[at[i] : at[i + 1]]) for i in rows.tolist()]
    return out ^ _START


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Borders of pieces of about CHUNK_BYTES that no word crosses."""
    start = 0
    while start < len(data):
        end = min(start + CHUNK_BYTES, len(data))
        while end < len(data) and _WORD[data[end - 1]] and _WORD[data[end]]:
            ahead = np.flatnonzero(~_WORD[data[end : end + CHUNK_BYTES]])
            end += int(ahead[0]) if len(ahead) else min(CHUNK_BYTES, len(data) - end)
        yield start, end
        start = end


def _words(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased bytes, and where each starts."""
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, starts


def features_of(texts: pa.Array, runs: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece of the texts: the text of each word, the text of each feature, and its bucket."""
    lowered = [(t or b"").lower() for t in texts.cast(pa.binary()).to_pylist()]  # of bytes: A-Z only
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
    data = np.frombuffer(b"\n".join(lowered), np.uint8)
    del lowered
    last, owner = pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    for start, end in _pieces(data):
        fresh, at = _words(data[start:end])
        carried = len(last)
        words = pa.concat_arrays([last, fresh])
        text = np.concatenate([owner, np.searchsorted(begin, at + start, "right") - 1])
        texts_of, found = [], []
        made = words
        for r in range(1, runs + 1):
            count = len(words) - r + 1
            if count <= 0:
                break
            if r > 1:
                made = pc.binary_join_element_wise(made.slice(0, count), words.slice(r - 1), pa.scalar(b" ", pa.large_binary()))
            one = (text[:count] == text[r - 1 :]) & (np.arange(count) + r > carried)  # in one text, and not counted before
            coded = made.filter(pa.array(one)).dictionary_encode()
            bucket = crc32s(coded.dictionary) % np.uint32(buckets)
            found.append(bucket[coded.indices.to_numpy()].astype(np.int64))
            texts_of.append(text[:count][one])
        if found:
            yield text[carried:], np.concatenate(texts_of), np.concatenate(found)
        keep = min(runs - 1, len(words))
        last, owner = words.slice(len(words) - keep), text[len(words) - keep :]


def bucket_counts(table: DataFrame, text: str, runs: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs: one row for each bucket and task is shuffled, one for each bucket is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in shards_of(batch, 0):
                for _, _, found in features_of(part.column(0), runs, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    made = in_tasks(table.select(F.col(text).alias("__text")), run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the log ratio, smoothed, as a whole number."""
    buckets = len(raw)
    more = (target + 1.0) * (float(raw.sum()) + buckets)
    return np.floor(1000 * np.log(more / ((raw + 1.0) * (float(target.sum()) + buckets)))).astype(np.int64)


def weighed(docs: DataFrame, text: str, keep: list[str], gains: np.ndarray, runs: int) -> DataFrame:
    """`keep` with __words, __features and __weight of each row."""

    def measure(texts: pa.Array) -> list:
        n = len(texts)
        words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
        for of_word, of_feature, found in features_of(texts, runs, len(gains)):
            words += np.bincount(of_word, minlength=n)
            features += np.bincount(of_feature, minlength=n)
            np.add.at(weight, of_feature, gains[found])
        return [words, features, weight]

    fields = [(name, T.LongType()) for name in ("__words", "__features", "__weight")]
    return mapped(docs, text, keep, fields, measure)


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel number fixed by seed and id, as a whole number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _scored(docs, target, doc_id, text, keep, runs, buckets, seed) -> DataFrame:
    gains = gains_of(bucket_counts(docs, text, runs, buckets), bucket_counts(target, text, runs, buckets))
    return weighed(docs, text, keep, gains, runs).withColumn("__score", F.col("__weight") + gumbel(F.col(doc_id), seed))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    runs: int = 2,
    buckets: int = 10_000,
    seed: int = 2024,
    min_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, and rank (null if not drawn).

    `target` has texts in a column of the same name. Of the documents with at
    least `min_words` words, `percent` % are drawn, rounded down.
    """
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__body"))
    found = _scored(rows, target.select(F.col(text).alias("__body")), "__id", "__body", ["__id"], runs, buckets, seed)
    scored = written(
        found.select(
            F.col("__id").alias("doc_id"), F.col("__words").alias("n_words"), F.col("__features").alias("n_features"),
            F.col("__weight").alias("weight"), F.col("__score").alias("score"),
        ),
        "importance-scores",
    )
    large = F.col("n_words") >= min_words
    eligible = scored.where(large)
    quota = percent * eligible.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features"), F.desc("n_words")]
    numbered = dense_number(eligible, order, "__rank")
    rank = F.when(F.col("__rank") <= quota, F.col("__rank")).cast("long").alias("rank")
    rest = scored.where(~large).select("*", F.lit(None).cast("long").alias("rank"))
    return numbered.select(*scored.columns, rank).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows with all their columns; texts neither move nor meet.

    The last drawn row's score and id (one row at the driver) are the cutoff;
    a row that repeats them is drawn, too.
    """
    ranks = importance_ranks(docs, target, doc_id, text, **options)
    last = ranks.where("rank IS NOT NULL").orderBy(F.desc("rank")).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    runs, buckets, seed = (options.get(k, d) for k, d in (("runs", 2), ("buckets", 10_000), ("seed", 2024)))
    scored = _scored(docs, target, doc_id, text, docs.columns, runs, buckets, seed)
    first = F.lit(True) if last.doc_id is None else F.col(doc_id) <= F.lit(last.doc_id)
    drawn = (F.col("__score") > last.score) | ((F.col("__score") == last.score) & F.coalesce(first, F.lit(False)))
    return scored.where(drawn & (F.col("__words") >= options.get("min_words", 20))).select(*docs.columns)
