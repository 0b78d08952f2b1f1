"""Trie self-join and importance draws, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, row
from tierhouse.llm import importance, simhash

LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_fingerprint(text, width=3):
    words = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows, fps, budget):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget or rows[i] is not None and rows[i] == rows[j]:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(rows))]


def test_simhash_of_odd_rows_and_given_documents(odd, table, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_BYTES", 2000)  # long texts in many pieces
    docs = odd.select("doc_id", "text").union(table("documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    want = Counter((d, f"{fp:016x}", c) for (d, _), fp, c in zip(rows, fps, plain_components([d for d, _ in rows], fps, 2)))
    for block in (simhash.BLOCK, 16):
        got = simhash.simhash_duplicates(docs, width=3, budget=2, block=block).collect()
        assert Counter(map(tuple, got)) == want


def crowd(seed, n, spread):
    """Numbers in crowds around a few centres, as signed and distinct."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    out = centres[rng.integers(0, 5, n)]
    for _ in range(spread):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate([out, rng.integers(0, 2**64, n, dtype=np.uint64)]))


@pytest.mark.parametrize("seed, budget, spread", [(1, 2, 1), (2, 2, 3), (3, 3, 2), (4, 0, 1)])
def test_trie_pairs_are_all_pairs(seed, budget, spread):
    a, b = crowd(seed, 150, spread), crowd(seed + 50, 120, spread)
    b = np.unique(np.concatenate([b, a[::7] ^ np.uint64(5)]))
    near = lambda x, y: np.bitwise_count(x[:, None] ^ y[None, :]) <= budget
    assert set(zip(*(x.tolist() for x in simhash.close_pairs(a, b, budget)))) == set(zip(*(x.tolist() for x in np.nonzero(near(a, b)))))
    assert set(zip(*(x.tolist() for x in simhash.close_pairs(a, a, budget)))) == set(zip(*(x.tolist() for x in np.nonzero(np.triu(near(a, a), 1)))))


@pytest.mark.parametrize("seed, budget, spread, block", [(5, 2, 2, 13), (6, 3, 2, 40), (7, 2, 1, 1000)])
def test_links_over_blocks_connect_what_is_close(spark, seed, budget, spread, block):
    values = crowd(seed, 400, spread)
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "__fp long").repartition(3)
    links = [tuple(r) for r in simhash.trie_links(fps, budget, block).collect()]
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    i, j = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= budget, 1))
    pairs = set(zip(i.tolist(), j.tolist()))
    got = [tuple(sorted((place[a], place[b]))) for a, b in links]
    groups = lambda some: simhash._forest(len(values), *np.array(sorted(some), np.int64).reshape(-1, 2).T).tolist()
    assert groups(got) == groups(pairs)
    assert len(links) < 20 * len(values)  # of a crowd a forest, not all pairs


def test_simhash_shares_ids_and_skips_nulls(spark):
    texts = ["a b c", "d e f", "g h i"]
    docs = spark.createDataFrame([(3, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[1]), (None, texts[2]), (9, None), (8, " ")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.simhash_duplicates(docs, width=3).collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (None, None), (9, 8), (8, 8)}


def test_empty_tables(empty):
    assert simhash.simhash_duplicates(empty).isEmpty()
    assert importance.importance_ranks(empty, empty).isEmpty() and importance.resampled(empty, empty).isEmpty()


def test_crc_of_any_length():
    rng = np.random.default_rng(2)
    some = [rng.bytes(n) for n in [*range(0, 200), 64, 64, 640, 6400, 100_001]]
    got = importance.crc32s(pa.array(some, pa.binary()))
    assert got.tolist() == [zlib.crc32(s) for s in some]
    assert importance.crc32s(pa.array(some, pa.large_binary()).slice(5, 9)).tolist() == [zlib.crc32(s) for s in some[5:14]]


def plain_importance(docs, target, runs, buckets, seed, min_words, percent):
    def of(text):
        words = [w.encode() for w in PLAIN.findall((text or "").translate(LOWER))]
        return len(words), [zlib.crc32(b" ".join(words[i : i + r])) % buckets for r in range(1, runs + 1) for i in range(len(words) - r + 1)]

    own, other = [of(t) for _, t in docs], [of(t) for t in target]
    s, t = Counter(b for _, f in own for b in f), Counter(b for _, f in other for b in f)
    n, m = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (m * 0 + n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in s}
    rows = []
    for (d, _), (words, f) in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2], -r[1]))
    drawn = order[: percent * len(order) // 100]
    ranked = Counter((*r, i + 1) for i, r in enumerate(drawn))
    return ranked + Counter((*r, None) for r, k in (Counter(rows) - Counter(drawn)).items() for _ in range(k))


@pytest.mark.parametrize("runs, buckets, min_words, percent", [(1, 10_000, 20, 10), (3, 500, 1, 37)])
def test_importance_of_odd_rows(odd, table, monkeypatch, runs, buckets, min_words, percent):
    monkeypatch.setattr(importance, "CHUNK_BYTES", 1500)  # words and runs across many pieces
    docs = odd.unionByName(table("documents").withColumns({c: F.lit("x") for c in odd.columns[5:]}).limit(60))
    target = table("benchmark")
    want = plain_importance([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], runs, buckets, 2024, min_words, percent)
    got = importance.importance_ranks(docs, target, runs=runs, buckets=buckets, min_words=min_words, percent=percent)
    assert Counter(map(tuple, got.collect())) == want


def test_resampled_rows_are_the_drawn_ones(spark, table):
    docs = table("documents")
    options = dict(runs=2, buckets=1000, min_words=20, percent=25)
    ranks = importance.importance_ranks(docs, table("benchmark"), **options).where("rank IS NOT NULL")
    drawn = importance.resampled(docs, table("benchmark"), **options)
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranks.collect())
    one = spark.createDataFrame([row(1, "word " * 30)], SCHEMA)
    assert importance.resampled(one, one, percent=100).count() == 1


def test_draws_prefer_the_target(spark):
    docs = [(i, " ".join(["apple pear" if i % 4 == 0 else "stone iron", f"w{i % 7}"] * 15)) for i in range(200)]
    target = spark.createDataFrame([("apple pear plum",)] * 20, "text string")
    got = importance.importance_ranks(spark.createDataFrame(docs, "doc_id long, text string"), target, percent=25)
    drawn = [r.doc_id for r in got.where("rank IS NOT NULL").collect()]
    assert len(drawn) == 50 and all(d % 4 == 0 for d in drawn)
