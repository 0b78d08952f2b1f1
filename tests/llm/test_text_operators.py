"""Operators that look at one text at a time, against plain versions."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierhouse.llm import language_id, pii, quality_bayes, quality_rules, token_counts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def plain_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    hit = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            dup += line in seen
        seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


@pytest.fixture(scope="module")
def labels(spark, odd):
    return odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


@pytest.mark.parametrize("which", ["odd", "given"])
def test_quality_measures(which, odd, labels, table):
    docs = odd if which == "odd" else table("documents")
    known = labels if which == "odd" else table("labels")
    out = quality_rules.quality_verdicts(docs, known)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter((r.doc_id, *plain_measures(r.text)) for r in docs.select("doc_id", "text").collect())
    assert by_row(out, *names) == want
    assert out.where("base_failed AND kept").isEmpty()


def test_exact_binomial():
    from math import comb

    for n, p in ((1, 0.3), (17, 0.01), (60, 0.2)):
        for k in range(n + 1):
            want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            got = quality_rules.binomial_at_most(k, n, p)
            assert got == pytest.approx(want) or (got == 1.0 and k >= n * p)
    assert quality_rules.binomial_at_most(0, 10**9, 0.01) == 0.0


def test_cutoffs_reject_junk_and_spare_good_documents(spark):
    # Every text is another: copies would be one trial.
    rows = [(i, " ".join(f"w{j}x{i}" if i % 3 else f"w{j}x{i}$$$" for j in range(80)), "en", int(i % 3 > 0)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    known = docs.select("doc_id", "quality", F.lit(0).alias("toxic"))
    out = quality_rules.quality_verdicts(docs, known).join(known, "doc_id")
    assert by_row(out, "quality", "kept") == {(1, True): 2000, (0, False): 1000}
    few = quality_rules.quality_verdicts(docs, known.limit(40))  # too few to be sure of anything
    assert few.where("NOT kept").isEmpty()


def test_repeated_rows_and_copies_certify_nothing(spark):
    def levels(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        known = docs.select("doc_id", F.when(F.col("text").contains("$"), 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
        return {r.level for r in quality_rules.quality_verdicts(docs, known).collect()}

    text = lambda i: " ".join(f"w{j}x{i}" if i % 3 else f"w{j}x{i}$$$" for j in range(80))
    few = [(i, text(i), "en") for i in range(120)]
    many = [(i, text(i), "en") for i in range(3000)]
    assert levels(few) == {0}
    assert levels(few * 25) == {0}  # the same rows again and again
    assert levels([(10_000 * k + i, t, c) for k in range(25) for i, t, c in few]) == {0}  # copies under other ids
    once = levels(many)
    assert once == levels(many + [(10_000 + i, t, c) for i, t, c in many]) and 0 not in once


def test_cutoffs_move_no_text(spark, table):
    kept = quality_rules.keep_good(table("documents"), table("labels"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_kept_rows_have_their_columns(odd, labels):
    out = quality_rules.keep_good(odd, labels)
    assert out.columns == odd.columns and {r.kept for r in out.collect()} == {"x"}


def test_token_counts_are_the_librarys(odd, table):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    extra = ["<|endoftext|>a<|endoftext|>", "aaaa" * 999, "it's they'LL \u3000\x85\x1c  x\u200b²½"]
    docs = odd.select("doc_id", "text").union(table("documents").select("doc_id", "text"))
    docs = docs.union(docs.sparkSession.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    out = token_counts.token_counts(docs, path, 1024)
    want = Counter()
    for r in docs.collect():
        t = r.text or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        want[r.doc_id, len(t.encode()), n, n > 1024] += 1
    assert by_row(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]
            if fits():
                out.append((kind, *m.span()))
    return out


def test_personal_data(odd, table):
    import random

    random.seed(2)
    pieces = [*"ab1234567890 ..--+()@@_%x", "1.2.3.4", "a@b.c", "4111111111111111", "+1 (267) 555-7228"]
    docs = odd.select("doc_id", "text").union(table("documents").select("doc_id", "text"))
    made = [(5000 + i, "".join(random.choices(pieces, k=40))) for i in range(3000)]
    docs = docs.union(docs.sparkSession.createDataFrame(made, "doc_id long, text string"))
    want = Counter()
    for r in docs.collect():
        spans = plain_spans(r.text)
        want[(r.doc_id, *(sum(s[0] == k for s in spans) for k in PATTERNS), ",".join(f"{k}:{a}:{b}" for k, a, b in spans))] += 1
    got = Counter()
    for r in pii.pii_spans(docs).collect():
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS)
        got[r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, base] += 1
    assert got == want


def test_added_kinds_need_checksum_or_context():
    assert [s[0] for s in pii.added_spans("account DE89 3704 0044 0532 0130 00.")] == ["iban"]
    assert pii.added_spans("account DE88 3704 0044 0532 0130 00.") == []
    assert [s[0] for s in pii.added_spans("my social security number is 123-45-6789")] == ["ssn"]
    assert pii.added_spans("part 123-45-6789") == []


@pytest.mark.parametrize(
    "before, iban, after",
    [
        ("IBAN ", "DE89 3704 0044 0532 0130 00", " BIC COBADEFFXXX"),
        ("", "GB82 WEST 1234 5698 7654 32", " EUR 500"),
        ("", "DE89370400440532013000", " 2024"),
        ("", "DE89370400440532013000", " 2024 OR LATER AND SO ON 1 2 3"),
        ("REF AB12 ", "DE89 3704 0044 0532 0130 00", ""),
        ("as part of the deal ", "DE89370400440532013000", " is used"),
        ("serial ", "GB82WEST12345698765432", "."),
    ],
)
def test_ibans_end_where_their_checksum_holds(before, iban, after):
    text = before + iban + after
    assert [s[:3] for s in pii.added_spans(text)] == [("iban", len(before), len(before) + len(iban))]
    assert pii.redact(text).startswith(f"{before}<IBAN>")


def test_every_registered_iban_length():
    import random

    random.seed(7)
    for country, n in pii._IBAN_LENGTHS.items():
        body = "".join(random.choices("0123456789", k=n - 4))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        iban = f"{country}{check:02d}{body}"
        grouped = " ".join(iban[i : i + 4] for i in range(0, n, 4))
        for made in (iban, grouped):
            assert [s[:3] for s in pii.added_spans(f"{made} AND 12 MORE")] == [("iban", 0, len(made))]


def test_redaction_keeps_rows_and_columns(odd):
    out = pii.redacted(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = {r.doc_id: r.text for r in out.where("text LIKE 'write%'").collect()}[14]
    assert text == "write to <EMAIL> or <IP>, card <CARD>, <PHONE>"
    assert out.where("n_chars <> length(text)").isEmpty()


def test_language_by_held_out_accuracy(table, odd, empty):
    docs = table("documents")
    out = language_id.identify(docs, ~language_id.held_out(F.col("doc_id"))).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where(language_id.held_out(F.col("doc_id")))
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    assert out.where("score < 0 OR score > 1").isEmpty()
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(odd, F.lit(True)).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (13, "und"), (None, "und")} <= got and (7, "und") not in got
    assert language_id.identify(odd, F.lit(False)).where("lang_pred <> 'und'").isEmpty()
    assert language_id.identify(empty, F.lit(True)).isEmpty()


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 20):
        code = language_id.codewords(n)
        distance = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(distance) >= max(1, code.shape[1] // 4)


def test_quality_scores(table, odd, labels, empty):
    docs, known = table("documents"), table("labels")
    out = quality_bayes.quality_scores(docs, known)
    assert out.count() == docs.count() and out.where("p_good < 0 OR p_good > 1 OR p_good IS NULL").isEmpty()
    both = out.join(known, "doc_id").where("toxic = 0")
    assert both.where("quality = 1 AND kept").count() >= 0.9 * both.where("quality = 1").count()
    assert quality_bayes.quality_scores(odd, labels).count() == odd.count()
    assert quality_bayes.quality_scores(odd, labels.limit(0)).where("NOT kept").isEmpty()
    assert quality_bayes.quality_scores(empty, labels).isEmpty()


def test_sparse_sites_shrink_to_their_parents(spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.2)] * 400 + [("small", "a", 0.0)] + [("other", "a", 0.6)] * 300
    df = spark.createDataFrame(rows, "h string, p string, __good double").withColumn("__toxic", F.lit(0.1))
    out = {(r.h, r.p): r.__getitem__("__good_site") for r in quality_bayes.with_sites(df, "h", "p").collect()}
    assert out["big", "a"] > 0.85 and out["big", "b"] < 0.25
    assert 0.3 < out["small", "a"] < 0.8  # one document says nothing; its own share is left out


def test_empty_tables(empty, odd, labels):
    import public_tokenizers

    assert quality_rules.quality_verdicts(empty, labels).isEmpty()
    assert quality_rules.quality_verdicts(odd, labels.limit(0)).count() == odd.count()
    assert token_counts.token_counts(empty, public_tokenizers.path("byte_bpe_50k.json"), 10).isEmpty()
    assert pii.pii_spans(empty).isEmpty() and pii.redacted(empty).isEmpty()


def test_ibans_need_their_country_and_its_length():
    def made(country, body):
        turned = "".join(str(int(c, 36)) for c in f"{body}{country}00")
        return f"{country}{98 - int(turned) % 97:02d}{body}"

    assert not pii.added_spans(" ".join(f"SKU ZZ{k:02d} 1111 2222 3333 4444" for k in range(100)))
    for country, size in (("ZZ", 16), ("DE", 17), ("DE", 19), ("NO", 12)):  # checksums that hold, for no such account
        assert not pii.added_spans(f"iban {made(country, '1234567890123456789'[:size])}")
    good = made("DE", "370400440532013000")
    assert [s[:3] for s in pii.added_spans(f"iban {good}")] == [("iban", 5, 5 + len(good))]
