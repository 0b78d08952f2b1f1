"""The quality classifier: what it learns from, folds, and site posteriors against plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tierhouse.llm import quality_bayes


def made(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(400)]
    return [(i, " ".join(rng.choices(words, k=60)), f"s{i % 9 if i % 3 else 0}", rng.choice(["en", "fr", None])) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t + (" vile" if i % 4 == 0 else " kind"), s, p) for i, t, s, p in made(600, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3).cache()


@pytest.fixture(scope="module")
def known(spark):
    rows = [(i, int(i % 4 > 0), int(i % 8 == 0)) for i in range(0, 600, 2)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def values(df, digits=9):
    return Counter(tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_repeated_rows_and_another_order_change_nothing(docs, known):
    learn = lambda d, k: quality_bayes.learnt_from(d, k, "doc_id", "text", 8000).collect()
    hot = docs.unionByName(docs.where("doc_id = 4").crossJoin(docs.sparkSession.range(500)).drop("id"))
    want = learn(docs, known)
    assert len(want) == 300
    assert learn(hot.repartition(5), known.union(known).repartition(2)) == want
    two = docs.unionByName(docs.where("doc_id < 50").withColumn("text", F.concat("text", F.lit(" more"))))
    assert len(learn(two, known)) == 300 and learn(two.repartition(7), known) == learn(two, known)
    assert values(quality_bayes.quality_scores(docs, known)) == values(quality_bayes.quality_scores(docs.repartition(6), known))


def test_the_sample_is_bounded(docs, known):
    assert 0 < quality_bayes.learnt_from(docs, known, "doc_id", "text", 60).count() < 100
    long = docs.sparkSession.range(40_000).agg(F.concat_ws(" ", F.collect_list(F.md5(F.col("id").cast("string")))).alias("text"))
    row = quality_bayes.learnt_from(long.withColumn("doc_id", F.lit(0)), known, "doc_id", "text", 8000).first()
    assert len(row["__slots"]) < 4200


def test_slots_come_back():
    import numpy as np

    slots = np.unique(np.random.default_rng(3).integers(0, quality_bayes.SLOTS, 700)).astype(np.int32)
    assert (quality_bayes._unpacked(quality_bayes._packed(slots)) == slots).all()


def test_held_out_documents_are_told_apart(docs, known):
    out = quality_bayes.quality_scores(docs, known).where("doc_id % 2 = 1 OR doc_id % 4 = 0")
    assert out.where("doc_id % 4 = 0 AND kept").isEmpty() and out.where("doc_id % 2 = 1 AND NOT kept").isEmpty()


def test_no_document_is_scored_by_what_learnt_from_it(spark):
    """Labels drawn by lot say nothing about other texts, so scores must not know them."""
    rng = random.Random(7)
    rows = made(1500, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    lots = {r[0]: rng.randint(0, 1) for r in rows}
    labels = spark.createDataFrame([(d, q, 0) for d, q in lots.items()], "doc_id long, quality int, toxic int")
    scores = defaultdict(list)
    for r in quality_bayes.quality_scores(docs, labels).collect():
        scores[lots[r.doc_id]].append(r.p_good_document)
    mean = {k: sum(v) / len(v) for k, v in scores.items()}
    assert abs(mean[1] - mean[0]) < 0.06


def plain_sites(rows):
    """(site prior, combined) of (host, path, p) rows."""

    def strength(groups):  # (n, sum, squares, centre)
        n = sum(g[0] for g in groups)
        between = sum(g[0] * (g[1] / g[0] - g[3]) ** 2 for g in groups)
        noise = sum(max(0.0, g[2] / g[0] - (g[1] / g[0]) ** 2) for g in groups)
        whole = sum(g[0] * g[3] * (1 - g[3]) for g in groups) / n
        spread = (between - noise) / n
        return min(1e6, max(1.0, whole / spread - 1)) if spread > 0 else 1e6

    paths, hosts = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        paths[h, p].append(x)
        hosts[h].append(x)
    mean = sum(x for _, _, x in rows) / len(rows)
    squares = lambda xs: sum(x * x for x in xs)
    k_host = strength([(len(xs), sum(xs), squares(xs), mean) for xs in hosts.values()])
    host_mean = {h: (sum(xs) + k_host * mean) / (len(xs) + k_host) for h, xs in hosts.items()}
    k_path = strength([(len(xs), sum(xs), squares(xs), host_mean[h]) for (h, _), xs in paths.items()])
    odds = lambda q: math.log(q / (1 - q))
    out = []
    for h, p, x in rows:
        xs = paths[h, p]
        site = (sum(xs) - x + k_path * host_mean[h]) / (len(xs) - 1 + k_path)
        out.append((site, 1 / (1 + math.exp(-(odds(x) - odds(mean) + odds(site))))))
    return out


def test_sites_by_hand(docs, known):
    given = {r.doc_id: (r.source, r.lang) for r in docs.collect()}
    got = quality_bayes.quality_scores(docs, known).orderBy("doc_id").collect()
    for head in ("good", "toxic"):
        want = plain_sites([(*given[r.doc_id], r[f"p_{head}_document"]) for r in got])
        for r, (site, whole) in zip(got, want):
            assert r[f"p_{head}_site"] == pytest.approx(site, abs=1e-9) and r[f"p_{head}"] == pytest.approx(whole, abs=1e-9)
    for r in got:
        assert r.kept == (r.p_good >= 0.5 and r.p_toxic <= 0.5) and r.is_toxic == (r.p_toxic > 0.5)
