"""Removal of passages that an earlier document already has, by suffix arrays of shards.

Every window of SPAN bytes belongs to the smallest hash among its GRAM-byte
grams. Neighbouring windows with the same smallest gram form a segment, and
segments travel to the shard of that gram, so equal windows of any two
documents meet there. A shard sorts the suffixes of its segments by induced
sorting and takes their permuted common prefixes: suffixes that share SPAN
bytes are one window, and all but those of the smallest id are removed.

Whole segments that repeat need no sorting: of equal ones, those of larger
ids are removed altogether. Each task finds them among the documents it holds
and sends one of them to the shard, so exact copies and passages that a third
of all documents share do not pile up there. Of the rest only those are sorted that
agree with another one of their gram in enough bytes on one side of it. Grams that a sample of the documents finds in very many of them
are replaced by the SMALL smallest grams of the window, which parts their
different surroundings over many shards. The sample decides where windows
meet, never which are removed.

Defined cases: a null text counts as empty; texts shorter than SPAN lose
nothing; positions are UTF-8 bytes; matches never cross documents; rows that
repeat an id do not remove from each other, and each is cut by itself; a null
id neither removes nor loses anything; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import _BYTE, _P, _P_INV, _power, in_tasks, mapped, mix64, shards_of, uniform
from tierhouse.llm.suffix_array import permuted_prefixes, suffix_array

SPAN, GRAM = 50, 12
WINDOW = SPAN - GRAM + 1
#: Bytes of segments in one suffix array.
BLOCK = 1 << 19
#: Bytes of text that a task packs together, and that a shard's segments come from at most, about.
PACKED, SHARD_BYTES, UNKNOWN_BYTES = 2 << 20, 64 << 20, 1 << 58
#: How hard shuffled bytes are compressed, which is what most of this operator's disk goes by.
LEVEL = 6
#: A gram is common if the sampled share of the documents has it this often.
SAMPLE, COMMON = 1 / 64, 2000
SMALL = 8


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` values."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    return out if have == width else np.minimum(out[: len(out) - (width - have)], out[width - have :])


def _window_keys(text: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of every window of the concatenated texts, and the hash of every gram."""
    n = len(text) - GRAM + 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[text] * _power(_P, len(text))[: len(text)])])
    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * _power(_P_INV, n)[:n])
    keys = _smallest(grams, WINDOW)
    if len(common):
        at = np.flatnonzero(np.isin(keys, common))
        for part in np.array_split(at, len(at) // 4096 + 1):
            # Equal grams count once, so that a window's key depends on its content alone.
            rows = np.sort(np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[part], axis=1)
            rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = np.uint64(2**64 - 1)
            rows = np.sort(rows, axis=1)[:, :SMALL]
            if len(rows):
                keys[part] = mix64((mix64(rows) * (np.arange(SMALL, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum(1))
    return keys, grams


def _gram_places(grams: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where in each run of windows the gram begins that is the key of all of them; -1 unless there is one such place."""
    # A gram is some window's smallest if the largest key of the windows around it is its own.
    around = ~_smallest(~np.concatenate([np.zeros(WINDOW - 1, np.uint64), keys, np.zeros(WINDOW - 1, np.uint64)]), WINDOW)
    chosen = np.flatnonzero(around == grams)
    if not len(chosen):
        return np.full(len(starts), -1, np.int64)
    i = np.searchsorted(chosen, ends)
    place = lambda j: chosen[np.clip(j, 0, len(chosen) - 1)]
    own = lambda j: (j >= 0) & (j < len(chosen)) & (grams[place(j)] == keys[starts])
    for _ in range(WINDOW):  # past grams that were chosen before this one came into the window
        on = ~own(i) & (i < len(chosen)) & (place(i) <= starts + WINDOW - 1)
        if not on.any():
            break
        i = i + on
    single = own(i) & (place(i) <= starts + WINDOW - 1)
    for j in (i - 1, i + 1):  # the same gram once more in the run
        single &= ~(own(j) & (place(j) >= starts) & (place(j) <= ends + WINDOW - 1))
    return np.where(single, place(i) - starts, -1)


def segments(texts: list[bytes], common: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, start, number of windows, key, place of the gram) of each segment, and the concatenated texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none, none, none, data
    keys, grams = _window_keys(data, common)
    base = np.concatenate([[0], np.cumsum(lengths)])
    inside = np.zeros(len(keys), bool)
    for i in np.flatnonzero(lengths >= SPAN):
        inside[base[i] : base[i + 1] - SPAN + 1] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (keys[1:] != keys[:-1])
    fresh[base[:-1][lengths >= SPAN]] = True
    starts = np.flatnonzero(fresh)
    total = np.cumsum(inside)
    ends = np.append(starts[1:], len(keys))
    windows = total[ends - 1] - total[starts] + 1
    owner = np.searchsorted(base, starts, "right") - 1
    place = _gram_places(grams, keys, starts, starts + windows - 1)
    return owner, starts - base[owner], windows, keys[starts].view(np.int64), place, data


#: Two bodies that share a window around their common gram agree in so many bytes left or right of it.
AROUND = (SPAN - GRAM + 1) // 2


def _body_hashes(data: np.ndarray, begin: np.ndarray, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """64-bit hashes of each body, and of its gram with AROUND bytes left and right (0: it has not so many).

    The arrays are eight times the data, so it comes in pieces.
    """
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _power(_P, len(data))[: len(data)])])
    inverse = _power(_P_INV, len(data))
    of = lambda a, n: mix64((sums[a + n] - sums[a]) * inverse[a] + n.astype(np.uint64))
    sides = []
    for low, high in ((place - AROUND, place + GRAM), (place, place + GRAM + AROUND)):
        fits = (place >= 0) & (low >= 0) & (high <= length)
        side = of(begin + np.where(fits, low, 0), np.where(fits, high - low, 0))
        sides.append(np.where(fits, side | np.uint64(1), np.uint64(0)))
    return of(begin, length), *sides


def _codes(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes, return_inverse=True)[1]


def _later(code: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether an equal body belongs to a smaller id."""
    low = np.full(int(code.max()) + 1 if len(code) else 0, np.iinfo(np.int64).max)
    np.minimum.at(low, code, ids)
    return low[code] < ids


#: n segments of a shard: compressed arrays of numbers and, unless they are known to repeat, their bodies.
_PACKS = "shard int, n bigint, size bigint, numbers binary, bodies binary"
_NUMBERS = (np.uint32, np.int64, np.int64, np.int32, np.int32, np.int16)  # key, id, part, start, windows, place of the gram


def _squeezed(raw: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True) if raw else b""


def _loosened(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _packs(shard: np.ndarray, columns: list[np.ndarray], data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for take in np.split(order, cuts):
        if len(take):
            numbers = b"".join(c[take].astype(kind).tobytes() for c, kind in zip(columns, _NUMBERS))
            size = int(length[take].sum())
            body = b""
            if size:
                offsets = np.concatenate([[0], np.cumsum(length[take])])
                body = data[np.repeat(begin[take] - offsets[:-1], length[take]) + np.arange(offsets[-1])].tobytes()
            yield int(shard[take[0]]), len(take), size, _squeezed(numbers), _squeezed(body)


def _unpacked(n: int, numbers: bytes) -> list[np.ndarray]:
    raw, out, at = _loosened(numbers, n * sum(np.dtype(k).itemsize for k in _NUMBERS)), [], 0
    for kind in _NUMBERS:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _segments_of(rows: DataFrame, common: np.ndarray, shards: int) -> DataFrame:
    """All segments of rows (__id, __part, __body), packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for part in shards_of(batch, 2, PACKED):
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                parts = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = [t or b"" for t in part.column(2).to_pylist()]
                owner, start, windows, key, place, data = segments(texts, common)
                if not len(owner):
                    continue
                begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[owner] + start
                length = windows + SPAN - 1
                # Of equal segments met here only the smallest id's travels with its bytes; the others are
                # removed for certain, so any shard can pass them on and a common one is not flooded.
                known = _later(_codes(_body_hashes(data, begin, length, place)[0]), ids[owner])
                key = mix64(key.view(np.uint64))
                shard = (key >> np.uint64(32)).astype(np.int64) % shards
                shard[known] = turn % shards
                turn += 1
                columns = [key & np.uint64(0xFFFFFF), ids[owner], parts[owner], start, windows, place]
                made = []
                for some, sizes in ((~known, length), (known, np.zeros_like(length))):
                    made += _packs(shard[some], [c[some] for c in columns], data, begin[some], sizes[some])
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["shard", "n", "size", "numbers", "bodies"]
                )

    return in_tasks(rows.select("__id", "__part", "__body"), run, _PACKS)


def _common_grams(rows: DataFrame) -> np.ndarray:
    """Grams that very many documents of the sample have; at most a few for each million documents of it."""
    sample = rows.where(uniform(F.col("__id"), F.lit(3)) < SAMPLE)
    none = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards_of(batch, 2):
                owner, _, _, key, _, _ = segments([t or b"" for t in part.column(2).to_pylist()], none)
                once = np.unique(np.stack([owner, key]), axis=1)[1]
                yield pa.RecordBatch.from_arrays([pa.array(once)], names=["key"])

    keys = in_tasks(sample.select("__id", "__part", "__body"), run, "key bigint")
    found = keys.groupBy("key").count().where(F.col("count") >= COMMON).select("key").toArrow().column("key")
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


def repeated_windows(bodies: list[bytes], ids: np.ndarray) -> np.ndarray:
    """For the concatenated bodies: whether a window starts here that a body of smaller id has, too."""
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    text = np.frombuffer(b"\0".join(bodies), np.uint8).astype(np.int64) + 1
    ends = np.cumsum(lengths + 1) - 1
    text[ends[:-1]] = 0  # between bodies
    owner = np.repeat(np.arange(len(bodies)), lengths + 1)[: len(text)]
    room = ends[owner] - np.arange(len(text))
    order = suffix_array(text, 257)
    shared = permuted_prefixes(text, order, room)[order]
    full = room[order] >= SPAN
    group = np.cumsum(~((shared >= SPAN) & full))[full]
    own = ids[owner[order[full]]]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    low = np.minimum.reduceat(own, first) if len(first) else own
    out = np.zeros(len(text), bool)
    out[order[full]] = low[np.cumsum(np.diff(group, prepend=-1) != 0) - 1] < own if len(first) else False
    return out


def _shared(values: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether a value (not 0) belongs to several codes."""
    order = np.lexsort((code, values))
    new = np.diff(values[order], prepend=values[order[:1]] + np.uint64(1)) != 0
    new_code = new | (np.diff(code[order], prepend=-1) != 0)
    group = np.cumsum(new) - 1
    out = np.empty(len(values), bool)
    out[order] = np.bincount(group, new_code)[group] > 1 if len(values) else new
    return out & (values != 0)


def _removed(columns: list[np.ndarray], data: np.ndarray, hashes: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """(id, part, first, last) of the byte ranges that a shard's segments lose."""
    key, ids, parts, start, windows, place = columns
    length = windows.astype(np.int64) + SPAN - 1
    begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    whole, to_left, to_right = hashes
    code = _codes(whole)
    later = _later(code, ids)
    yield ids[later], parts[later], start[later], start[later] + length[later]
    # What is left has different bodies, but for repeats inside one document. Bodies can only match others of
    # their key, and if these agree with them to the left or right of the gram.
    left = np.flatnonzero(~later)
    salt = mix64(key[left].astype(np.uint64) + np.uint64(1))
    near = [_shared(np.where(s[left] != 0, mix64(s[left] ^ salt) | np.uint64(1), s[left]), code[left]) for s in (to_left, to_right)]
    open_ = np.isin(key[left], key[left][place[left] < 0])  # some body of the key has no such place
    left = left[near[0] | near[1] | open_]
    left = left[np.lexsort((code[left], key[left]))]
    new_key = np.diff(key[left].astype(np.int64), prepend=-1) != 0
    new_code = new_key | (np.diff(code[left], prepend=-1) != 0)
    group = np.cumsum(new_key) - 1
    several = np.bincount(group, new_code)[group] > 1 if len(left) else new_key
    left, group = left[several], group[several]
    # Whole keys to a block.
    ends = np.cumsum(length[left] + 1)
    last_of_group = np.append(np.diff(group) != 0, True)[: len(left)]
    first = 0
    for i in np.flatnonzero(last_of_group):
        if ends[i] - (ends[first - 1] if first else 0) >= BLOCK or i == len(left) - 1:
            yield _sorted_block(left[first : i + 1], columns, data, begin, length)
            first = i + 1


def _sorted_block(take: np.ndarray, columns: list[np.ndarray], data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    _, ids, parts, start, _, _ = (c[take] for c in columns)
    bodies = [data[a : a + n].tobytes() for a, n in zip(begin[take], length[take])]
    bad = repeated_windows(bodies, ids)
    edge = np.diff(np.concatenate([[False], bad, [False]]).astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    base = np.concatenate([[0], np.cumsum(length[take] + 1)])
    i = np.searchsorted(base, a, "right") - 1
    at = start[i] + a - base[i]
    return ids[i], parts[i], at, at + b - a + SPAN - 1


def _ranges(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed byte ranges of a shard."""

    def made(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["id", "part", "first", "last"])

    held, bodies, hashes = [], [], []
    for batch in rows:
        for n, size, numbers, body in zip(*(batch.column(c).to_pylist() for c in ("n", "size", "numbers", "bodies"))):
            columns = _unpacked(n, numbers)
            if size:
                held.append(columns)
                bodies.append(_loosened(body, size))
                length = columns[4].astype(np.int64) + SPAN - 1
                own = np.frombuffer(bodies[-1], np.uint8)
                hashes.append(_body_hashes(own, np.cumsum(length) - length, length, columns[5].astype(np.int64)))
            else:  # known to repeat
                _, ids, parts, start, windows, _ = columns
                yield made((ids, parts, start, start + windows + SPAN - 1))
    if held:
        data = np.frombuffer(b"".join(bodies), np.uint8)
        bodies.clear()
        columns = [np.concatenate(c) for c in zip(*held)]
        held.clear()
        for columns in _removed(columns, data, tuple(map(np.concatenate, zip(*hashes)))):
            yield made(columns)


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(__of, __in, __ranges) for rows with __id, __part, __body that lose something."""
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < UNKNOWN_BYTES else 0  # Spark takes a frame that is no file for endless
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-known // SHARD_BYTES))
    packs = _segments_of(docs, _common_grams(docs), shards)
    ranges = in_tasks(packs.repartitionById(shards, F.col("shard")), _ranges, "id bigint, part bigint, first bigint, last bigint")
    return ranges.groupBy(F.col("id").alias("__of"), F.col("part").alias("__in")).agg(
        F.collect_list(F.struct("first", "last")).alias("__ranges")
    )


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as one."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)
    return first[new], last[ends]


def _compressed(rows: DataFrame) -> DataFrame:
    def measure(texts: pa.Array) -> list:
        bodies = texts.to_pylist()
        return [pa.array([len(b) for b in bodies], pa.int64()), pa.array([_squeezed(b) for b in bodies], pa.binary())]

    return mapped(rows, "__body", ["__id", "__part"], [("__size", T.LongType()), ("__packed", T.BinaryType())], measure)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__body"))
    repeats = not docs.groupBy(F.col(doc_id)).count().where("count > 1").isEmpty()
    # Only where ids repeat does a row need more than its id to be told apart.
    rows = rows.withColumn("__part", F.xxhash64("__body") if repeats else F.lit(0).cast("long"))
    ranges = removed_ranges(rows.where("__id IS NOT NULL"))
    joined = _compressed(rows).join(ranges, (F.col("__id") == F.col("__of")) & (F.col("__part") == F.col("__in")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards_of(batch, 3):
                out = []
                for found, size, packed in zip(part.column(1), part.column(2).to_pylist(), part.column(3).to_pylist()):
                    body = _loosened(packed, size)
                    if not found.is_valid:
                        out.append((len(body), 0, 0, hashlib.sha256(body).hexdigest(), body))
                        continue
                    first, last = merged(*(found.values.field(i).to_numpy() for i in (0, 1)))
                    edges = [0, *np.stack([first, last], 1).ravel().tolist(), len(body)]
                    kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((len(body), len(body) - len(kept), len(first), hashlib.sha256(kept).hexdigest(), kept))
                columns = list(zip(*out))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
                )

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary"
    return in_tasks(joined.select("__id", "__ranges", "__size", "__packed"), run, schema)
