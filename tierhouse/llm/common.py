"""Helpers of the operators: row batches in tasks, vectorised words, written tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.scratch import written

__all__ = ["column_or_null", "in_tasks", "mapped", "shards_of", "ship_package", "uniform", "written", "Words", "words_of", "mix64"]

#: Bytes of text that a task holds as arrays at a time.
CHUNK_BYTES = 1 << 20


def shards_of(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text and at most `rows` rows; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > limit or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield batch.slice(start)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that none has to have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def in_tasks(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """mapInArrow with this package at hand in the tasks."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def mapped(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[tuple[str, T.DataType]],
    measure: Callable[[pa.Array], list],
    rows: int = 4096,
) -> DataFrame:
    """The columns of `keep` and, for each row, what `measure` makes of its text.

    `measure` gets the texts of a bounded slice as an Arrow array and returns
    one array or list for each of `fields`. Rows neither move nor meet.
    """
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, t) for n, t in fields)])
    names = [f.name for f in schema.fields]
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards_of(batch, width, rows=rows):
                made = measure(part.column(width))
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *map(pa.array, made)], names=names)

    return in_tasks(source, run, schema)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column, or nulls of that type if the table has none of that name."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def uniform(*columns: Column | str) -> Column:
    """A number in [0, 1) fixed by the values of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)).cast("double") / F.lit(float(1 << 53))


_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept for the next slice."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, CHUNK_BYTES * 2), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have


class Words:
    """The words of a slice of texts: a hash for each and the first word of each text."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes = hashes  # uint64
        self.first = first  # text i has the words first[i] .. first[i + 1] - 1


def words_of(texts: list[bytes | None], lower: bool) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text by a hash of their bytes; null has none."""
    joined = b"\n".join(t or b"" for t in texts)
    if lower:
        joined = joined.lower()  # of bytes: A-Z only
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _power(_P, len(data))[: len(data)])])
    hashes = mix64((sums[ends] - sums[starts]) * _power(_P_INV, len(data))[starts])
    return Words(hashes, np.searchsorted(starts, begin))
