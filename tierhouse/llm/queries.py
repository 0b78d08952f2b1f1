"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierhouse.llm import (
    conversations,
    decontaminate,
    importance,
    language_id,
    minhash,
    mixing,
    pii,
    quality_bayes,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    url_templates,
)

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register f(table) under `name`; `table(t)` reads a given table."""

    def register(build: Callable) -> Callable:
        QUERIES[name] = lambda spark, folder: build(lambda t: spark.read.parquet(f"{folder.rstrip('/')}/{t}.parquet"))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_minhash")
def op1(table: Callable[[str], DataFrame]) -> DataFrame:
    return minhash.near_duplicates(table("documents"), width=3, percent=85)


@query("op2_quality_bayes")
def op2(table: Callable[[str], DataFrame]) -> DataFrame:
    return quality_bayes.quality_scores(table("documents"), table("labels"))


@query("op3_quality_rules")
def op3(table: Callable[[str], DataFrame]) -> DataFrame:
    return quality_rules.quality_verdicts(table("documents"), table("labels"))


@query("op4_mixing")
def op4(table: Callable[[str], DataFrame]) -> DataFrame:
    return mixing.mixture(table("documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


@query("op5_token_counts")
def op5(table: Callable[[str], DataFrame]) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table("documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op6_suffix_dedup")
def op6(table: Callable[[str], DataFrame]) -> DataFrame:
    return suffix_dedup.without_repeats(table("documents")).drop("kept_bytes")


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op7_url_templates")
def op7(table: Callable[[str], DataFrame]) -> DataFrame:
    """Labels of the same id stand for the pages': the tables have no other."""
    labels = table("labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return url_templates.url_verdicts(table("pages"), labels, URL_RULES)


_WINNOWING_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_window),
doc_window AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, gram)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM split LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op8_decontamination", _WINNOWING_SQL)
def op8(table: Callable[[str], DataFrame]) -> DataFrame:
    return decontaminate.contaminated_rows(table("documents"), table("benchmark"))


@query("op9_pii")
def op9(table: Callable[[str], DataFrame]) -> DataFrame:
    return pii.pii_spans(table("documents"))


@query("op10_language_id")
def op10(table: Callable[[str], DataFrame]) -> DataFrame:
    docs = table("documents")
    learn = ~language_id.held_out(F.col("doc_id"))
    return language_id.identify(docs, learn).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


#: CRC-32 of a list of bytes, with the table of a byte's steps as the column `step`.
_CRC_STEPS_SQL = """
crc_steps AS (
  SELECT list(c ORDER BY i) AS step FROM (
    SELECT i, list_reduce([i] || list_transform(range(8), lambda k: 0::BIGINT), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def _crc_sql(text: str) -> str:
    octets = f"list_transform(range(1, len(hex(encode({text}))) // 2 + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295)"


def _put(state: str, cost: str, edit: str) -> str:
    """A state's nine digits of cost and its audit, after an edit; so written, the least is the cheapest, then ASCII-least."""
    return f"lpad((substr({state}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{edit}'"


def _alignment_sql() -> str:
    """The repair as a fold over turns, with the cheapest audit for each state of the grammar."""
    old = {s: f"x.{s}" for s in "nsua"}  # nothing yet, after system, after user, after assistant
    inserted = {
        "n": "x.n",
        "s": "x.s",
        "u": f"least(x.u, {', '.join(_put(old[s], '2', 'I') for s in 'nsa')})",
        "a": f"least(x.a, {_put('x.u', '2', 'I')}, {', '.join(_put(old[s], '4', 'II') for s in 'ns')})",
    }
    never = "'900000000'"
    may = lambda test, value: f"CASE WHEN NOT y.must AND {test} THEN {value} ELSE {never} END"
    step = lambda sign, froms: ", ".join(
        f"{may('y.i = ' + repr(sign), _put(old[s], 'y.cut', 'K'))}, {may('true', _put(old[s], '2 + y.cut', 'R'))}" for s in froms
    )
    edited = {
        "n": _put("x.n", "3", "D"),
        "s": f"least({_put('x.s', '3', 'D')}, {may("y.i = 's'", _put('x.n', 'y.cut', 'K'))})",
        "u": f"least({_put('x.u', '3', 'D')}, {step('u', 'nsa')})",
        "a": f"least({_put('x.a', '3', 'D')}, {step('a', 'u')})",
    }
    fields = lambda made: ", ".join(f"{s}: {made[s]}" for s in "nsua")
    given = "i: y.i, must: y.must, cut: y.cut, edits: y.edits"
    return f"""
WITH {_CRC_STEPS_SQL},
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc_steps),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM marked WHERE kind <> 0)),
placed AS (
  SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
         rtrim(text, e' \\t\\n\\x0b\\x0c\\r') AS body
  FROM hurt),
faulty AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 AS twice,
         lag(i) OVER (PARTITION BY conv_id ORDER BY nth) || i AS pair
  FROM placed),
judged AS (SELECT *, NOT blank AND NOT twice AND right(body, 1) NOT IN ('.', '!', '?') AS cut FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
         sum(twice::INT) AS duplicate, sum(cut::INT) AS truncated,
         coalesce(sum((pair NOT IN ('su', 'ua', 'au'))::INT), 0) AS illegal
  FROM judged GROUP BY conv_id),
folded AS (
  SELECT conv_id, list_reduce(
    [{{n: '000000000', s: {never}, u: {never}, a: {never}, i: '', must: false, cut: 0, edits: false}}] || flatten(list(
      [{{n: '', s: '', u: '', a: '', i: i, must: blank OR twice, cut: cut::INT, edits: false}},
       {{n: '', s: '', u: '', a: '', i: i, must: blank OR twice, cut: cut::INT, edits: true}}] ORDER BY nth)),
    lambda x, y: CASE WHEN y.edits THEN {{{fields(edited)}, {given}}} ELSE {{{fields(inserted)}, {given}}} END) AS x
  FROM judged GROUP BY conv_id),
best AS (
  SELECT conv_id, substr(z, 1, 9)::BIGINT AS cost, substr(z, 10) AS audit
  FROM (SELECT conv_id, least(x.n, x.a, {_put('x.u', '2', 'I')}, {_put('x.s', '4', 'II')}) AS z FROM folded)),
edits AS (
  SELECT conv_id, k, audit[k] AS op, len(replace(audit[1:k], 'I', '')) AS nth, len(replace(audit[1:k], 'D', '')) AS line
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)),
lines AS (
  SELECT e.conv_id, e.k, e.line, e.op, CASE WHEN e.op <> 'I' THEN j.role END AS role, CASE WHEN e.op = 'I' THEN '' ELSE j.text END AS text,
         max(CASE WHEN e.op = 'K' AND j.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS head
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.nth = j.nth AND e.op <> 'I' WHERE e.op <> 'D'),
hashed AS (
  SELECT conv_id, sha256(string_agg(
           CASE WHEN op = 'K' THEN role WHEN (line - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS h
  FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN hashed h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""


@query("op11_conversation_repair", _alignment_sql())
def op11(table: Callable[[str], DataFrame]) -> DataFrame:
    turns = table("conversations")
    return conversations.structure_audit(conversations.damaged(turns), ids=turns).drop("turns")


@query("op12_simhash")
def op12(table: Callable[[str], DataFrame]) -> DataFrame:
    return simhash.simhash_duplicates(table("documents"), width=3, budget=2, seed=42)


_IMPORTANCE_SQL = (
    r"""
WITH """
    + _CRC_STEPS_SQL
    + r""",
split AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
own AS (SELECT rid, f, count(*) AS n FROM (SELECT rid, unnest(w) AS f FROM split) GROUP BY ALL),
other AS (SELECT f, count(*) AS n FROM (SELECT unnest(w) AS f FROM goal) GROUP BY ALL),
bucket_of AS (
  SELECT f, """
    + _crc_sql("f")
    + r""" % 10000 AS b
  FROM (SELECT f FROM own UNION SELECT f FROM other), crc_steps),
raw AS (SELECT b, sum(n) AS s FROM own JOIN bucket_of USING (f) GROUP BY b),
target AS (SELECT b, sum(n) AS t FROM other JOIN bucket_of USING (f) GROUP BY b),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw) AS s_all, (SELECT coalesce(sum(t), 0) FROM target) AS t_all),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM raw LEFT JOIN target USING (b), total),
weighed AS (SELECT rid, sum(n * g) AS weight FROM own JOIN bucket_of USING (f) JOIN gain USING (b) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256(concat('2024:', doc_id)), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weighed USING (rid)),
placed AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place, count(*) OVER () AS n
           FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (rid)
"""
)


@query("op13_importance", _IMPORTANCE_SQL)
def op13(table: Callable[[str], DataFrame]) -> DataFrame:
    return importance.importance_ranks(
        table("documents"), table("benchmark"), runs=1, buckets=10_000, seed=2024, min_words=20, percent=10
    ).select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Build]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
