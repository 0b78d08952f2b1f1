"""Near-duplicates by SimHash: fingerprints joined with themselves along a binary trie.

The trie of all distinct fingerprints is their sorted order: a node is the run
of those that share a prefix. Pairs of nodes go down together, bit by bit; a
pair counts the bits in which its prefixes differ and is dropped as soon as
they are more than the budget.

The upper part of the trie is cut into blocks of neighbouring fingerprints, at
borders that follow the data, so that a crowded prefix has more of them. Tasks
walk their fingerprints against the trie of the borders, and each goes to the
blocks that it could have a partner in: its own and, for log2(blocks) = d, at
most about d * d / 4 others, as a pair of blocks meets in one of the two.
Inside a block the walk goes on to single fingerprints. A block returns the
links of a spanning forest only, at most one for each fingerprint, whatever
the size of a group; components of all blocks are then joined.

Equal fingerprints are one before they are joined, so copies, however many,
cost nothing. Borders (at most MAX_BLOCKS numbers) are all that the driver sees.

Defined cases: no words and a null text have fingerprint zero and are linked
like any other; fewer words than a shingle make one shingle; rows of one id
are one document, so what one of its texts is linked with, all are; rows
without an id link others but name none, and a component without any id is
null; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import CHUNK_BYTES, in_tasks, mapped, ship_package, written
from tierhouse.llm.components import components

BITS = 64
#: Distinct fingerprints in a block, and how many blocks there are at most (beyond that, blocks grow).
BLOCK = 4096
MAX_BLOCKS = 1 << 18
#: Fingerprints that a task walks down at a time.
SLICE = 1 << 15
_TOP = np.uint64(1 << 63)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _hashes(text: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, in pieces; a piece begins with the last words of the one before."""
    carried: list[bytes] = []
    at, some = 0, False
    while at < len(text):
        cut = _SPACE.search(text, at + CHUNK_BYTES)
        end = cut.start() if cut else len(text)
        words = carried + text[at:end].lower().split()  # of bytes: A-Z and ASCII white space only
        at = end
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
            yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)
            some = True
        carried = words[len(words) - width + 1 :] if len(words) >= width else words
    if carried and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed)], np.uint64)


def fingerprint(text: bytes | None, width: int, seed: int = 42) -> int:
    """The bits that more than half of a text's shingle hashes have, as a signed integer."""
    set_bits, count = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(text or b"", width, seed):
        for part in np.array_split(hashes, len(hashes) // SLICE + 1):
            set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(hashes)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, width: int, seed: int) -> DataFrame:
    """__id and __fp of each row."""

    def measure(texts: pa.Array) -> list:
        return [pa.array([fingerprint(t, width, seed) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())]

    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__body"))
    return mapped(rows, "__body", ["__id"], [("__fp", T.LongType())], measure)


def _along(fps: np.ndarray) -> np.ndarray:
    """Signed fingerprints as unsigned numbers in the same order; differences between two stay the same."""
    return fps.view(np.uint64) ^ _TOP


class _Trie:
    """Sorted distinct numbers; a node is a range of them."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._ones = np.zeros(len(values) + 1, np.int64)

    def at(self, bit: int) -> None:
        np.cumsum((self.values >> np.uint64(bit)) & np.uint64(1), out=self._ones[1:], dtype=np.int64)

    def split(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the child with the bit set begins."""
        return high - (self._ones[high] - self._ones[low])


def close_pairs(a: np.ndarray, b: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of sorted distinct a and b that differ in at most `budget` bits; a with itself if b is a: i < j."""
    same = b is a
    one, two = _Trie(a), _Trie(b)
    found = []
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alo, ahi = np.array([0]), np.array([len(a)])
    blo, bhi, differ = np.array([0]), np.array([len(b)]), np.array([0], np.int8)
    for bit in range(BITS - 1, -2, -1):
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            near &= (i < j) if same else True
            found.append((i[near], j[near]))
            alo, ahi, blo, bhi, differ = (x[~single] for x in (alo, ahi, blo, bhi, differ))
        if bit < 0 or not len(alo):
            break
        one.at(bit)
        if not same:
            two.at(bit)
        amid, bmid = one.split(alo, ahi), (one if same else two).split(blo, bhi)
        children = []
        for a_set in (False, True):
            for b_set in (False, True):
                parts = (amid, ahi) if a_set else (alo, amid), (bmid, bhi) if b_set else (blo, bmid)
                (x, y), (u, v) = parts
                count = differ + np.int8(a_set != b_set)
                live = (x < y) & (u < v) & (count <= budget)
                if same and a_set and not b_set:
                    live &= alo != blo  # of a node with itself, one order of its children is enough
                children.append((x[live], y[live], u[live], v[live], count[live]))
        alo, ahi, blo, bhi, differ = (np.concatenate(x) for x in zip(*children))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest of its component."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def block_links(own: np.ndarray, visitors: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among a block's own numbers, and with its visitors."""
    own, visitors = np.sort(own), np.sort(visitors)
    parts = [own, *(visitors[k : k + SLICE] for k in range(0, len(visitors), SLICE))]
    for k, part in enumerate(parts):
        i, j = close_pairs(own, own if k == 0 else part, budget)
        if not len(i):
            continue
        nodes = own if k == 0 else np.concatenate([own, part])
        label = _forest(len(nodes), i, j if k == 0 else j + len(own))
        linked = np.flatnonzero(label != np.arange(len(nodes)))
        yield nodes[label[linked]], nodes[linked]


def block_of(borders: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.maximum(np.searchsorted(borders, values, "right") - 1, 0)


def visits(values: np.ndarray, borders: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, place of the value): the blocks, other than its own, that each of sorted values is to look into."""
    trie, blocks, places = _Trie(values), [], []
    low, high = np.array([0]), np.array([len(values)])
    prefix, differ = np.zeros(1, np.uint64), np.zeros(1, np.int8)
    for bit in range(BITS - 1, -2, -1):
        last = prefix + np.uint64((1 << (bit + 1)) - 1)
        first_block, last_block = block_of(borders, prefix), block_of(borders, last)
        leaf = first_block == last_block  # the node lies in one block; always so at the bottom
        if leaf.any():
            sizes = (high - low)[leaf]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            blocks.append(np.repeat(first_block[leaf], sizes))
            places.append(np.repeat(low[leaf], sizes) + inside)
            low, high, prefix, differ = (x[~leaf] for x in (low, high, prefix, differ))
        if not len(low):
            break
        trie.at(bit)
        mid = trie.split(low, high)
        children = []
        for a_set in (False, True):
            x, y = (mid, high) if a_set else (low, mid)
            for b_set in (False, True):
                count = differ + np.int8(a_set != b_set)
                live = (x < y) & (count <= budget)
                under = prefix | np.uint64(b_set << bit)
                children.append((x[live], y[live], under[live], count[live]))
        low, high, prefix, differ = (np.concatenate(x) for x in zip(*children))
    block, place = np.concatenate(blocks), np.concatenate(places)
    block, place = np.divmod(np.unique(block * len(values) + place), len(values))  # a block may be several nodes
    own = block_of(borders, values)[place]
    # Of two blocks one is visited: the higher if their sum is even, else the lower.
    goes = (block != own) & ((block > own) == ((block + own) % 2 == 0))
    return block[goes], place[goes]


def _borders(fps: DataFrame, block: int) -> np.ndarray:
    """The first number of each block, in order; range partitions follow the data."""
    count = min(MAX_BLOCKS, fps.count() // block + 1)
    lows = fps.repartitionByRange(count, "__fp").groupBy(F.spark_partition_id()).agg(F.min("__fp").alias("low")).collect()
    return np.sort(_along(np.array([r.low for r in lows], np.int64)))


def trie_links(fps: DataFrame, budget: int, block: int = BLOCK) -> DataFrame:
    """(a, b) that connect all distinct fingerprints (column __fp) within `budget` bits of each other."""
    borders = _borders(fps, block)
    names = ["block", "fp", "home"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(given), SLICE):
                values = np.sort(_along(given[k : k + SLICE]))
                to, place = visits(values, borders, budget)
                blocks = np.concatenate([block_of(borders, values), to])
                fp = np.concatenate([values, values[place]]) ^ _TOP
                home = np.arange(len(blocks)) < len(values)
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(fp.view(np.int64)), pa.array(home)], names=names)

    def meet(group: pa.Table) -> pa.Table:
        values = _along(group.column("fp").to_numpy())
        home = group.column("home").to_numpy()
        made = [(x ^ _TOP, y ^ _TOP) for x, y in block_links(values[home], values[~home], budget)]
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*made)) if made else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": a, "b": b})

    ship_package(fps.sparkSession)
    routed = in_tasks(fps.select("__fp"), route, "block long, fp long, home boolean")
    return routed.groupBy("block").applyInArrow(meet, "a long, b long")


def simhash_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, budget: int = 2, seed: int = 42, block: int = BLOCK
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id that can be reached)."""
    own = written(fingerprints(docs, doc_id, text, width, seed), "simhash-fingerprints")
    classes = written(own.groupBy("__fp").agg(F.min("__id").alias("__low")), "simhash-classes")
    links = trie_links(classes.select("__fp"), budget, block) if not classes.isEmpty() else classes.selectExpr("__fp AS a", "__fp AS b")
    # Texts of one id are one document.
    several = own.where("__id IS NOT NULL").groupBy("__id").agg(F.min("__fp").alias("a"), F.max("__fp").alias("z")).where("a <> z")
    of_id = own.join(several, "__id").where("a <> __fp").select("a", F.col("__fp").alias("b")).distinct()
    groups = components(written(links.unionByName(of_id), "simhash-links"))
    named = classes.join(groups.withColumnRenamed("node", "__fp"), "__fp", "left").withColumn("__group", F.coalesce("component", "__fp"))
    lowest = named.groupBy("__group").agg(F.min("__low").alias("__component"))
    of_class = named.join(lowest, "__group").select(F.col("__fp").alias("__f"), "__component")
    return own.join(of_class, F.col("__fp") == F.col("__f")).select(
        F.col("__id").alias("doc_id"),
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        F.col("__component").alias("component_id"),
    )
