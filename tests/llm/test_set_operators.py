"""Operators that compare documents, against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierhouse.llm import components, decontaminate, minhash, mixing, suffix_array, suffix_dedup, url_templates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def plain_components(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common)
            same_id = rows[i][0] == rows[j][0] and rows[i][0] is not None and sets[i] and sets[j]
            if linked or same_id:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return Counter((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(width, percent, odd, table):
    # Of documents without an id each text stands for itself.
    docs = odd.where("doc_id IS NOT NULL").select("doc_id", "text").union(table("documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    got = minhash.near_duplicates(docs, width=width, percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_near_copies_without_a_perfect_hub(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, width=3, percent=85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 3, 85)


def test_one_of_each_keeps_columns_and_ids(odd, empty):
    out = minhash.one_of_each(odd)
    assert out.columns == odd.columns
    ids = [r.doc_id for r in out.where("doc_id IS NOT NULL").collect()]
    assert len(ids) == len(set(ids)) and 7 in ids and not {8, 9} & set(ids)
    assert out.where("doc_id IS NULL").count() == 2
    assert minhash.one_of_each(empty).isEmpty() and minhash.near_duplicates(empty).isEmpty()


def test_one_of_each_by_id_and_text(spark):
    import corpus_pipeline

    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    near = texts["a"].replace("a59", "changed")
    rows = [(3, texts["a"]), (14, texts["b"]), (14, texts["c"]), (20, texts["d"]), (20, texts["a"]), (21, texts["e"]), (21, near)]
    want = {(3, texts["a"]), (14, texts["b"]), (14, texts["c"]), (20, texts["d"]), (21, texts["e"])}
    for more in ([], [(30, texts["f"])] * 2):  # an id that repeats changes nothing for the others
        docs = spark.createDataFrame([*rows, *more], "doc_id long, text string")
        out = corpus_pipeline.near_dedup(spark, docs, "")
        assert Counter(map(tuple, out.collect())) == Counter({*want, *more})
    ids = [tuple(r) for r in minhash.one_of_each(docs).collect()]
    assert sorted(d for d, _ in ids) == [3, 14, 20, 21, 30] and {(20, texts["d"]), (21, texts["e"])} <= set(ids)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200}
    assert got == want


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[500:])
    s = minhash.signatures([a, b], 512)
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.08


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    rng = np.random.default_rng(3)
    for alphabet_limit in (1024, 0):
        monkeypatch.setattr(suffix_array, "SMALL_ALPHABET", alphabet_limit)
        for _ in range(300):
            n, k = rng.integers(1, 70), rng.integers(1, 5)
            text = rng.integers(0, k, n)
            symbols = text.tolist()
            order = sorted(range(n), key=lambda i: symbols[i:])
            assert suffix_array.suffix_array(text, int(k)).tolist() == order
            shared = suffix_array.permuted_prefixes(text, np.array(order), n - np.arange(n))
            for a, b in zip(order, order[1:]):
                m = 0
                while max(a, b) + m < n and symbols[a + m] == symbols[b + m]:
                    m += 1
                assert shared[b] == m


def plain_repeats(rows):
    """Smaller ids first; windows of equal ids do not remove each other."""
    seen, out = set(), Counter()
    by_id = defaultdict(list)
    for d, t in rows:
        by_id[d].append((t or "").encode())
    for d in sorted(by_id):
        fresh = set()
        for body in by_id[d]:
            gone = bytearray(len(body))
            for p in range(len(body) - 49):
                window = body[p : p + 50]
                if window in seen:
                    gone[p : p + 50] = b"\1" * 50
                else:
                    fresh.add(window)
            kept = bytes(c for c, g in zip(body, gone) if not g)
            spans = len(re.findall(b"\1+", bytes(gone)))
            out[d, len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
        seen |= fresh
    return out


@pytest.mark.parametrize("common", [200, 3])
def test_suffix_dedup(common, odd, table, monkeypatch):
    if common == 3:  # every gram that a few documents have counts as common
        monkeypatch.setattr(suffix_dedup, "COMMON", common)
        monkeypatch.setattr(suffix_dedup, "SAMPLE", 1.1)
        monkeypatch.setattr(suffix_dedup, "BLOCK", 5000)
    docs = odd.where("doc_id IS NOT NULL").select("doc_id", "text").union(table("documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    got = suffix_dedup.without_repeats(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain_repeats(rows)


def test_suffix_dedup_of_odd_tables(odd, empty):
    out = suffix_dedup.without_repeats(odd)
    assert out.count() == odd.count() and out.where("doc_id IS NULL AND n_removed > 0").isEmpty()
    assert suffix_dedup.without_repeats(empty).isEmpty()


def plain_hits(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p : p + n])].add(i)
    sizes = {len(w) for w in windows}
    out = Counter()
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if own := windows.get(tuple(w[p : p + n])):
                    hit |= set(range(p, p + n))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out[d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)] += 1
    return out


@pytest.fixture(scope="module")
def items(spark, table):
    own = [(1000, "one"), (1001, None), (1002, "..."), (1003, "One, two"), (1004, "word word word word word word word word word word word word"), (1005, "same id other"), (1003, "One, two")]
    return table("benchmark").union(spark.createDataFrame(own, "item_id long, text string"))


def test_decontamination(odd, table, items):
    docs = odd.select("doc_id", "text").union(table("documents").select("doc_id", "text"))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    out = decontaminate.contaminated_rows(docs, items)
    want = plain_hits([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert Counter(tuple(r[c] for c in names) for r in out.collect()) == want
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_decontaminated_rows(odd, items, empty):
    out = decontaminate.without_contaminated(odd, items)
    assert out.columns == odd.columns and {4, 5, 6, 11}.isdisjoint({r.doc_id for r in out.collect()})
    assert decontaminate.without_contaminated(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.contaminated_rows(empty, items).isEmpty()


def test_documents_and_items_with_one_instruction(spark, monkeypatch):
    """Items are listed once for all documents that hit the same windows; few or many keys give the same."""
    said = " ".join(f"i{k}" for k in range(40))
    some = lambda a, n: " ".join(f"{a}x{k}" for k in range(n))
    docs = [(d, f"{some(f'd{d}', 5)} {said} {some(f'e{d}', 3)}") for d in range(60)] + [(100, some("i9", 30)), (101, f"{some('z', 3)} {said[:20]}")]
    items = [(i, f"{said} {some(f'q{i}', 6)}") for i in range(50)] + [(90, some("q", 12)), (None, said), (91, "i3 i4")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_hits(docs, [(("" if i is None else i), t) for i, t in items])
    for few in (decontaminate.FEW_KEYS, 0):
        monkeypatch.setattr(decontaminate, "FEW_KEYS", few)
        got = decontaminate.contaminated_rows(*frames).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == Counter(k[:4] + k[5:] for k in want.elements())


def test_items_without_an_id(spark, tmp_path):
    import duckdb

    from tierhouse.llm import queries

    texts = [" ".join(f"{c}{i}" for i in range(14)) for c in "abcd"]
    items = [(None, texts[0]), (None, texts[1]), (None, "short one"), (3, texts[1]), (4, texts[2]), (4, "other text"), (5, "short one")]
    docs = [(1, f"x {texts[0]} y"), (2, texts[1]), (3, f"{texts[0]} {texts[2]}"), (4, texts[3]), (5, "a short one"), (6, f"other text {texts[1]}"), (7, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    name = "op8_decontamination"
    out = queries.queries()[name](spark, str(tmp_path))
    want = con.sql(queries.oracle_sql()[name]).to_arrow_table().select(out.columns).to_pylist()
    assert Counter(map(tuple, out.collect())) == Counter(tuple(r.values()) for r in want)
    left = decontaminate.without_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {4, 7}


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        target = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("which", ["odd", "given", "capped"])
def test_mixture(which, odd, table, spark):
    docs = {"odd": odd, "given": table("documents")}.get(which)
    if docs is None:
        rows = [(i, "w " * (5 + i % 40), "tiny" if i < 4 else f"s{i % 3}" if i < 1000 else None) for i in range(2000)]
        docs = spark.createDataFrame([*rows, (9000, " ", "blank")], "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    size = Counter((r.doc_id, r.source, len(WORDS.findall(r.text or ""))) for r in docs.select("doc_id", "source", "text").collect())
    assert Counter((r.doc_id, r.source, r.size) for r in got) == size
    sums = defaultdict(int)
    for (_, s, n), times in size.items():
        sums[s] += n * times
    want = plain_targets(sums)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sums[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert r.copies in (int(r.target / max(r.source_size, 1) + 1e-9), int(r.target / max(r.source_size, 1) + 1e-9) + 1) or not r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sums:
        assert abs(taken[s] - want[s]) <= 0.5 * largest[s] + 1e-6
    again = mixing.mixture(docs.repartition(2)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_pivoting_keeps_expectations(spark):
    """Over many sources of the same documents each document is taken as often as it is due."""
    rows = [(s * 100 + d, "w " * (3 + 7 * d), f"{s:04d}") for s in range(600) for d in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    due, seen = defaultdict(float), defaultdict(float)
    for r in mixing.mixture(docs).collect():
        due[r.doc_id % 100] += r.target / r.source_size
        seen[r.doc_id % 100] += r.copies
    assert all(abs(due[d] - seen[d]) < 75 for d in range(7))  # five standard errors; the largest is the one rounded last


def test_mixed_rows(odd, empty):
    taken = sum(r.copies for r in mixing.mixture(odd).collect())
    out = mixing.mixed(odd)
    assert out.columns == [*odd.columns, "copy"] and out.count() == taken
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert mixing.mixed(empty).isEmpty()


def test_mixing_of_rows_that_agree(spark):
    """Hot classes of equal ids, sources and sizes: sums are met, and the mix takes what the mixture says."""
    equal = spark.range(0, 200_000, 1, 4).selectExpr("CAST(NULL AS BIGINT) doc_id", "'a b c' text", "'hot' source", "id extra")
    some = spark.range(400).selectExpr("id % 7 doc_id", "concat('v', id % 5, ' w') text", "CAST(id % 3 AS STRING) source", "id extra")
    docs = equal.union(some)
    got = mixing.mixture(docs).groupBy("doc_id", "source", "size", "target", "copies").count().collect()
    assert sum(r["count"] for r in got) == 200_400
    by_source, target = Counter(), {}
    for r in got:
        by_source[r.source] += r.copies * r.size * r["count"]
        target[r.source] = r.target
    assert all(abs(by_source[s] - t) <= 2 for s, t in target.items())
    out = mixing.mixed(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    wanted, taken = Counter(), Counter()
    for r in got:
        if r.copies:
            wanted[r.doc_id, r.source, r.size, r.copies] += r["count"]
    for r in out.groupBy("doc_id", "source", "text", "extra").agg(F.count("*").alias("n"), F.max("copy").alias("last")).groupBy("doc_id", "source", F.size(F.split("text", " ")).cast("long").alias("size"), "n", "last").count().collect():
        assert r.n == r.last
        taken[r.doc_id, r.source, r.size, r.n] += r["count"]
    assert taken == wanted


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_url_rules_and_parts(spark, table):
    urls = ["http://WWW.Example.com/en/1?x", "https://a.example.com/en/", "x.com/en", None, "http://a.com", "http://b.NET/es/a#b", "s://example.com?/en/", "://n.com/A/b", "http://Notcom/"]
    pages = table("pages").select("page_id", "url").union(spark.createDataFrame(list(enumerate(urls, 10_000)), "page_id long, url string"))
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    for r in url_templates.url_verdicts(pages, labels, RULES).join(pages, "page_id").collect():
        host, path = "", ""
        if r.url and "://" in r.url:
            host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", r.url.split("://", 1)[1], re.S).groups()
            host = host.translate(LOWER)
        fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, action = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, action)


def test_url_templates_reject_bad_branches(spark):
    rows = []
    for i in range(400):
        rows.append((i, f"http://h.org/good/{i}", i % 20 == 0))
        rows.append((1000 + i, f"http://h.org/spam/page-{i}.html", i % 20 != 0))
        rows.append((2000 + i, f"http://wide.org/{'abcdefghij'[i % 10]}x{'klmnopqrstuv'[i % 12]}{chr(97 + i // 20)}/end", False))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    labels = pages.where("page_id % 2 = 0").select("page_id", "bad")
    out = url_templates.url_verdicts(pages, labels, [])
    seen = Counter((r.template, r.verdict) for r in out.collect())
    assert seen == {("h.org/good/*", "allow"): 400, ("h.org/spam/*", "block"): 400, ("wide.org/*/*", "allow"): 400}
    assert url_templates.url_verdicts(pages.limit(0), labels, []).isEmpty()


def test_frequent_branch_beside_many_rare_ones(spark):
    letters = "".join(chr(97 + i) for i in range(26))
    rows = [(i, f"http://h.org/{letters[i % 26]}{letters[i // 26 % 26]}{letters[i // 676]}/home", False) for i in range(1500)]
    rows += [(10_000 + i, f"http://h.org/casino/{i}", True) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    out = url_templates.url_verdicts(pages, pages.select("page_id", "bad"), [])
    assert Counter((r.template, r.verdict) for r in out.collect()) == {("h.org/*/*", "allow"): 1500, ("h.org/casino/*", "block"): 100}


def test_branches_of_deep_paths(spark):
    rows = []
    for i in range(200):
        rows.append((i, f"http://h.org/2024/05/a/b/c/news/{'x/' * (i % 3)}{i}", False))
        rows.append((1000 + i, f"http://h.org/2024/05/a/b/c/casino/{'x/' * (i % 3)}{i}", True))
        rows.append((2000 + i, f"http://flat.org/a/b/c/d/e/f{'/y' * (i % 4)}", False))
        rows.append((3000 + i, f"http://length.org/a/b/c/d/e/{i}{'/1' * (i % 2)}", i % 2 == 0))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    out = url_templates.url_verdicts(pages, pages.select("page_id", "bad"), [])
    want = {
        ("h.org/*/*/*/*/*/news/**", "allow"): 200,
        ("h.org/*/*/*/*/*/casino/**", "block"): 200,
        ("flat.org/*/*/*/*/*/**", "allow"): 200,
        ("length.org/*/*/*/*/*/*", "block"): 100,
        ("length.org/*/*/*/*/*/*/*", "allow"): 100,
    }
    assert Counter((r.template, r.verdict) for r in out.collect()) == want


def test_texts_of_one_id_are_one_document(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b), (11, c), (9, c), (12, " "), (12, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, width=3, percent=85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in got if r.n_shingles} == {3: 3, 5: 3, 7: 3, 9: 9, 11: 9, 12: 9}
