"""The pipeline, and the verdicts of the quality rules, against plain Python over the same rows."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_set_operators import WORDS, plain_components, plain_hits, plain_targets
from tests.llm.test_text_operators import plain_measures, plain_spans
from tierhouse.llm import pii, quality_rules

LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.006)


def plain_bins(text):
    """The six scores of a text, each in its bin."""
    text = text or ""
    n, chars, symbols, dup_lines, repeated, _ = plain_measures(text)
    some = max(n, 1)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    upper = sum("A" <= c <= "Z" for c in text)
    letters = upper + sum("a" <= c <= "z" for c in text)
    marks = text.count("!") + text.count("?")
    scores = (
        symbols / some, dup_lines / max(len(lines), 1), repeated / some,
        max(0.0, chars / some - 5) / 5, upper / max(letters, 1), marks / some,
    )
    return [min(255, int(28 * math.log2(1 + 64 * s))) for s in scores]


def plain_cutoffs(rows, labels, alpha, delta):
    """{stratum: (level, cutoff of each rule)} of (id, text, stratum) rows and (id, quality, toxic) labels."""
    truth = defaultdict(list)
    for d, quality, toxic in labels:
        if d is not None and quality is not None:
            truth[d].append((quality, toxic or 0))
    texts = {}
    for d, text, stratum in rows:
        if d in truth and not plain_measures(text)[-1]:
            texts.setdefault((stratum, text or ""), []).extend(truth[d])
    known = []
    for (stratum, text), marks in texts.items():
        quality, toxic = min(q for q, _ in marks), max(t for _, t in marks)
        if quality == 0 or toxic == 0:
            half = xxhash.xxh64_intdigest(hashlib.blake2b(text.encode(), digest_size=16).digest(), seed=42) % 2
            known.append((stratum, half, quality == 1, plain_bins(text)))
    strata = {k[0] for k in known}
    out = {}
    for s in strata:
        first = [(good, bins) for t, half, good, bins in known if t == s and half == 0]
        trials = [bins for t, half, good, bins in known if t == s and half == 1 and good]
        if not first or not trials:
            continue
        all_good = sum(g for g, _ in first)
        all_bad = len(first) - all_good
        ladder = []
        for share in LEVELS:
            cuts = []
            for rule in range(6):
                fits = []
                for cut in {bins[rule] for _, bins in first}:
                    good = sum(g for g, bins in first if bins[rule] >= cut)
                    bad = sum(not g for g, bins in first if bins[rule] >= cut)
                    if bad and bad * all_good >= 5 * good * all_bad and good <= share * all_good:
                        fits.append(cut)
                cuts.append(min(fits, default=1000))
            ladder.append(cuts)
        level = 0
        for cuts in ladder:
            n, k = len(trials), sum(any(b >= c for b, c in zip(bins, cuts)) for bins in trials)
            chance = sum(math.comb(n, i) * alpha**i * (1 - alpha) ** (n - i) for i in range(k + 1))
            if chance > delta / len(strata):
                break
            level += 1
        if level:
            out[s] = level, ladder[level - 1]
    return out


def plain_keeps(text, cut):
    return not plain_measures(text)[-1] and not (cut and any(b >= c for b, c in zip(plain_bins(text), cut[1])))


def test_verdicts_of_the_quality_rules(spark):
    """Base rules, ladder, exact tests and verdicts, with limits that some hundred labels can certify."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    # Shouting is made a mark of bad documents, so that some cutoff is worth having.
    bad = F.col("quality") == 0
    docs = docs.join(labels.select("doc_id", "quality"), "doc_id", "left").withColumn(
        "text", F.when(bad, F.concat("text", F.lit(" LOUD!" * 400))).otherwise(F.col("text"))
    ).select("doc_id", "text", "lang").cache()
    rows = [tuple(r) for r in docs.collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    cuts = plain_cutoffs(rows, marks, 0.2, 0.05)
    got = quality_rules.quality_verdicts(docs, labels, alpha=0.2, delta=0.05).collect()
    want = Counter((d, plain_keeps(t, cuts.get(s)), cuts.get(s, (0,))[0]) for d, t, s in rows)
    assert Counter((r.doc_id, r.kept, r.level) for r in got) == want
    assert any(r.level and not r.kept and not r.base_failed for r in got)


def plain_redacted(text):
    spans = sorted([*plain_spans(text), *(s[:3] for s in pii.added_spans(text))], key=lambda s: (s[1], -s[2]))
    out, end = "", 0
    for kind, start, stop in spans:
        if start >= end:
            out += text[end:start] + f"<{kind.upper()}>"
        end = max(end, stop)
    return out + text[end:]


def plain_chain(rows, labels, items):
    """What the first four stages leave of (id, text, lang, source, n_chars, ...) rows, and how many each stage left."""
    cuts = plain_cutoffs([(r[0], r[1], r[2]) for r in rows], labels, 0.01, 0.05)
    rows = [r for r in rows if plain_keeps(r[1], cuts.get(r[2]))]
    left = [len(rows)]
    nameless = [r for r in rows if r[0] is None]
    named = list({(r[0], r[1]): r for r in rows if r[0] is not None}.values())
    found = plain_components([(r[0], r[1]) for r in named], 5, 80)
    rows = nameless + [r for r in named if any(d == r[0] == c for d, _, c in found)]
    left.append(len(rows))
    hit = {(d, n): h for d, n, h, *_ in plain_hits([(i, r[1]) for i, r in enumerate(rows)], items)}
    rows = [r for i, r in enumerate(rows) if not any(h for (d, _), h in hit.items() if d == i)]
    left.append(len(rows))
    out = []
    for r in rows:
        text = plain_redacted(r[1])
        out.append((r[0], text, r[2], r[3], len(text), *r[5:]))
    return out, left


@pytest.fixture
def folder(spark, table, tmp_path):
    """The small tables, and rows of every kind that a stage has to decide on."""
    docs = table("documents").withColumns({"copy": F.lit("x"), "kept": F.lit("y")})
    given = [r for r in docs.collect() if len(WORDS.findall(r.text)) > 80]
    clean = [r for r in given if len(WORDS.findall(r.text)) < 600][:6]
    passage = next(r.text for r in table("benchmark").collect() if len(WORDS.findall(r.text)) > 20)
    words = clean[1].text.split(" ")
    words[len(words) // 2] = "changed"
    prose = lambda a: " ".join(f"{a}{i}" for i in range(90))
    rows = [
        (9001, clean[0].text, "en", "s1"),  # a copy
        (9002, " ".join(words), "en", "s1"),  # a near copy
        (9003, prose("b") + " " + passage + " " + prose("c"), "fr", None),
        (9004, prose("d") + " write to a.b@mail.example.com or DE89 3704 0044 0532 0130 00, card 4111 1111 1111 1111.", None, "s2"),
        (9005, prose("e"), None, None),
        (9005, prose("e"), None, None),  # a repeated row
        (None, prose("f"), "de", "s2"),
        (None, prose("g") + " 1.2.3.4", None, None),
        (9006, None, "en", "s1"),
        (9007, " \n", "en", "s1"),
        (9008, "word " * 60, "en", "s1"),
        (9009, "too short", "de", "s3"),
        (9010, " ".join(f"h{i}" for i in range(40_000)), "de", "s9"),
    ]
    more = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "y") for r in rows], docs.schema)
    docs.union(more).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(name).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_pipeline_by_hand(spark, folder):
    docs, labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = [tuple(r) for r in docs.collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    want, left = plain_chain(rows, marks, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert len(rows) > left[0] > left[1] > left[2] and {9005, None} <= {r[0] for r in want}

    counts, stage_docs = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stage_docs = stage(spark, stage_docs, folder).cache()
        assert stage_docs.columns == docs.columns
        counts.append(stage_docs.count())
    assert counts == [*left, left[-1]]
    assert Counter(map(tuple, stage_docs.collect())) == Counter(want)

    sizes = Counter()
    for r in want:
        sizes[r[3]] += len(WORDS.findall(r[1]))
    targets = plain_targets(sizes)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:-1] == docs.columns and len(set(out.columns)) == len(out.columns)
    copies, taken = defaultdict(list), Counter()
    for r in map(tuple, out.collect()):
        copies[r[:-1]].append(r[-1])
        taken[r[3]] += len(WORDS.findall(r[1]))
    assert set(copies) <= set(want)
    for r in want:
        due = targets[r[3]] / sizes[r[3]]
        assert sorted(copies[r]) == list(range(1, len(copies[r]) + 1))
        assert int(due + 1e-9) <= len(copies[r]) <= min(3, int(due + 1e-9) + 1)
    for source, words in sizes.items():
        longest = max(len(WORDS.findall(r[1])) for r in want if r[3] == source)
        assert abs(taken[source] - targets[source]) <= 0.5 * longest + 1e-6


@pytest.mark.parametrize("bare", [("documents",), ("labels", "benchmark"), ("documents", "labels", "benchmark")])
def test_pipeline_of_empty_tables(spark, table, tmp_path, bare):
    for name in ("documents", "labels", "benchmark"):
        rows = table(name)
        (rows.limit(0) if name in bare else rows).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*table("documents").columns, "copy"]
    assert out.isEmpty() == ("documents" in bare)
