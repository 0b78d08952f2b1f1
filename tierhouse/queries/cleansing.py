"""Cleansing rules.

The given tables are clean, so dirt is added by arithmetic on keys. That input
text is the same SQL for both engines; the rules themselves are written twice.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierhouse.functions import dates, numbers, rules, sql, text
from tierhouse.operators import rows, validation
from tierhouse.operators.joins import lookup_with_defaults
from tierhouse.queries.registry import plain, query

WS = "' ' || chr(9)"  # the blanks used as dirt here

STATUS_LABELS = {"O": "Open", "F": "Filled", "P": "Partial"}

DIRTY_ORDER = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'X'
       WHEN o_orderkey % 3 = 0 THEN ' ' || lower(o_orderstatus)
       WHEN o_orderkey % 3 = 1 THEN o_orderstatus || chr(9) ELSE o_orderstatus END AS raw_status,
  CASE o_orderkey % 7 WHEN 0 THEN 'm' WHEN 1 THEN 'FEMALE ' WHEN 2 THEN ' Male' WHEN 3 THEN 'f'
       WHEN 4 THEN '?' WHEN 5 THEN '' ELSE NULL END AS raw_gender
FROM {orders}"""


@query(
    "code_decode",
    f"""WITH src AS ({plain(DIRTY_ORDER)})
SELECT o_orderkey,
  CASE upper(trim(raw_status, {WS})) WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' WHEN 'P' THEN 'Partial'
       ELSE 'n/a' END AS status_label,
  CASE WHEN upper(trim(raw_gender, {WS})) IN ('F', 'FEMALE') THEN 'Female'
       WHEN upper(trim(raw_gender, {WS})) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gender
FROM src""",
)
def code_decode(src):
    return src.sql(DIRTY_ORDER).select(
        "o_orderkey", text.decode("raw_status", STATUS_LABELS).alias("status_label"), text.gender("raw_gender").alias("gender")
    )


DIRTY_COUNTRY = """
SELECT c_custkey,
  CASE n_nationkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN ' USA' WHEN 2 THEN 'US' WHEN 3 THEN '' WHEN 4 THEN NULL
       WHEN 5 THEN chr(9) || n_name || ' ' WHEN 6 THEN 'de' ELSE n_name END AS raw_country
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


@query(
    "country_std",
    f"""WITH src AS ({plain(DIRTY_COUNTRY)})
SELECT c_custkey,
  CASE WHEN trim(raw_country, {WS}) = 'DE' THEN 'Germany'
       WHEN trim(raw_country, {WS}) IN ('US', 'USA') THEN 'United States'
       WHEN trim(raw_country, {WS}) = '' OR raw_country IS NULL THEN 'n/a'
       ELSE trim(raw_country, {WS}) END AS country
FROM src""",
)
def country_std(src):
    return src.sql(DIRTY_COUNTRY).select("c_custkey", text.country("raw_country").alias("country"))


DIRTY_NAME = """
SELECT p_partkey,
  CASE p_partkey % 5 WHEN 0 THEN '  ' || upper(p_name) || ' ' WHEN 1 THEN replace(p_name, ' ', '-') || chr(9)
       WHEN 2 THEN ' ' || replace(p_name, ' ', '.') WHEN 3 THEN NULL ELSE p_name || ' jr' END AS raw_name,
  ' ' || upper(replace(p_name, ' ', '.')) || '@Example.COM' || chr(9) AS raw_email
FROM {part}"""


@query(
    "name_clean",
    f"""WITH src AS ({plain(DIRTY_NAME)})
SELECT p_partkey, trim(raw_name, {WS}) AS trimmed,
  array_to_string(list_transform(regexp_extract_all(lower(trim(raw_name, {WS})), '([a-z0-9]+|[^a-z0-9]+)'),
    lambda t: upper(t[1:1]) || t[2:]), '') AS titled,
  lower(trim(raw_email, {WS})) AS email
FROM src""",
)
def name_clean(src):
    return src.sql(DIRTY_NAME).select(
        "p_partkey",
        text.clean_name("raw_name").alias("trimmed"),
        text.clean_name("raw_name", "title").alias("titled"),
        text.clean_email("raw_email").alias("email"),
    )


@query(
    "name_split",
    f"""WITH src AS ({plain(DIRTY_NAME)})
SELECT p_partkey, trim(string_split(raw_name, ' ')[1], {WS}) AS first_name,
  trim(string_split(raw_name, ' ')[2], {WS}) AS last_name,
  trim(string_split(trim(raw_name, {WS}), ' ')[1], {WS}) AS first_trimmed,
  trim(string_split(trim(raw_name, {WS}), ' ')[2], {WS}) AS last_trimmed
FROM src""",
)
def name_split(src):
    return src.sql(DIRTY_NAME).select(
        "p_partkey",
        text.name_part("raw_name", 0).alias("first_name"),
        text.name_part("raw_name", 1).alias("last_name"),
        text.name_part("raw_name", 0, pre_trim=True).alias("first_trimmed"),
        text.name_part("raw_name", 1, pre_trim=True).alias("last_trimmed"),
    )


PART_KEY = """
SELECT p_partkey, upper(substr(p_type, 1, 2)) || '-' || upper(substr(p_name, 1, 2)) || '-' || p_brand AS raw_key
FROM {part}"""


@query(
    "key_split",
    f"""WITH src AS ({plain(PART_KEY)})
SELECT p_partkey, replace(substr(raw_key, 1, 5), '-', '_') AS cat_id, substr(raw_key, 7) AS prd_key FROM src""",
)
def key_split(src):
    return src.sql(PART_KEY).select(
        "p_partkey", text.category_of_key("raw_key").alias("cat_id"), text.product_of_key("raw_key").alias("prd_key")
    )


CUSTOMER_CODE = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NAS' ELSE '' END || c_name AS raw_cid,
  'AW-' || CAST(c_custkey AS STRING) || '-' || CAST(c_nationkey AS STRING) AS raw_code
FROM {customer}"""


@query(
    "prefix_strip",
    f"""WITH src AS ({plain(CUSTOMER_CODE)})
SELECT c_custkey, CASE WHEN raw_cid LIKE 'NAS%' THEN substr(raw_cid, 4) ELSE raw_cid END AS cid,
  replace(raw_code, '-', '') AS code FROM src""",
)
def prefix_strip(src):
    return src.sql(CUSTOMER_CODE).select(
        "c_custkey", text.strip_prefix("raw_cid").alias("cid"), text.strip_separator("raw_code").alias("code")
    )


ORDER_DAY_NUMBER = """
SELECT o_orderkey,
  CASE o_orderkey % 10 WHEN 0 THEN CAST(0 AS BIGINT) WHEN 1 THEN NULL
       WHEN 2 THEN CAST(substr(day_text, 1, 7) AS BIGINT) ELSE CAST(day_text AS BIGINT) END AS number,
  CASE o_orderkey % 10 WHEN 3 THEN CAST(substr(day_text, 1, 4) || '1332' AS BIGINT)
       ELSE CAST(day_text AS BIGINT) END AS doubtful
FROM (SELECT o_orderkey, replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') AS day_text FROM {orders}) d"""


@query(
    "yyyymmdd_date",
    f"""WITH src AS ({plain(ORDER_DAY_NUMBER)})
SELECT o_orderkey,
  CASE WHEN number = 0 OR length(CAST(number AS VARCHAR)) <> 8 THEN NULL
       ELSE CAST(strptime(CAST(number AS VARCHAR), '%Y%m%d') AS DATE) END AS strict_day,
  CAST(try_strptime(CAST(doubtful AS VARCHAR), '%Y%m%d') AS DATE) AS lenient_day
FROM src""",
)
def yyyymmdd_date(src):
    return src.sql(ORDER_DAY_NUMBER).select(
        "o_orderkey",
        dates.date_from_number("number").alias("strict_day"),
        dates.date_from_number("doubtful", strict=False).alias("lenient_day"),
    )


LINE_MEASURES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 13 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(l_quantity) AS BIGINT) END AS quantity,
  CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS BIGINT)
       WHEN 2 THEN -CAST(round(l_extendedprice) AS BIGINT) ELSE CAST(round(l_extendedprice) AS BIGINT) END AS price,
  CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN -CAST(round(l_extendedprice * l_quantity) AS BIGINT)
       WHEN 2 THEN CAST(7 AS BIGINT)
       ELSE CAST(round(l_quantity) AS BIGINT) * CAST(round(l_extendedprice) AS BIGINT) END AS sales
FROM {lineitem}"""


@query(
    "measure_repair",
    f"""WITH src AS ({plain(LINE_MEASURES)})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity,
  CASE WHEN sales IS NULL OR sales <= 0 OR sales <> quantity * abs(price) THEN quantity * abs(price)
       ELSE sales END AS sales,
  CASE WHEN price IS NULL OR price <= 0 THEN sales // nullif(quantity, 0) ELSE price END AS price
FROM src""",
)
def measure_repair(src):
    measures = ("sales", "quantity", "price")
    return src.sql(LINE_MEASURES).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "quantity",
        numbers.repair_sales(*measures).alias("sales"),
        numbers.repair_price(*measures).alias("price"),
    )


@query(
    "future_date_null",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) > DATE '2000-01-01' THEN NULL
  ELSE CAST(o_orderdate AS DATE) END AS order_day FROM orders""",
)
def future_date_null(src):
    return src.orders.select(
        "o_orderkey", dates.future_to_null(F.col("o_orderdate").cast("date"), "2000-01-01").alias("order_day")
    )


NULLED_COST = """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(round(p_retailprice) AS BIGINT) END AS cost FROM {part}"""


@query(
    "null_default",
    f"WITH src AS ({plain(NULLED_COST)}) SELECT p_partkey, coalesce(cost, 0) AS cost FROM src",
)
def null_default(src):
    return src.sql(NULLED_COST).select("p_partkey", numbers.null_to_zero("cost").alias("cost"))


TWO_GENDERS = """
SELECT c_custkey,
  CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'n/a' WHEN 2 THEN 'Female' ELSE NULL END AS crm_gender,
  CASE c_nationkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN NULL WHEN 2 THEN 'n/a' ELSE 'Male' END AS erp_gender
FROM {customer}"""


@query(
    "source_precedence",
    f"""WITH src AS ({plain(TWO_GENDERS)})
SELECT c_custkey, CASE WHEN crm_gender <> 'n/a' THEN crm_gender ELSE coalesce(erp_gender, 'n/a') END AS gender
FROM src""",
)
def source_precedence(src):
    return src.sql(TWO_GENDERS).select("c_custkey", rules.prefer("crm_gender", "erp_gender").alias("gender"))


PRICE_TEXT = """
SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)
       WHEN 1 THEN ' Free ' WHEN 2 THEN chr(9) WHEN 3 THEN NULL WHEN 4 THEN 'abc'
       ELSE ' ' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS raw_price
FROM {part}"""


@query(
    "price_parse",
    f"""WITH src AS ({plain(PRICE_TEXT)})
SELECT p_partkey, CAST(CASE WHEN raw_price IS NULL OR trim(raw_price, {WS}) IN ('') OR lower(trim(raw_price, {WS})) = 'free'
  THEN 0 ELSE coalesce(try_cast(replace(trim(raw_price, {WS}), '$', '') AS DECIMAL(38,9)), 0) END AS DECIMAL(18,4)) AS price
FROM src""",
)
def price_parse(src):
    return src.sql(PRICE_TEXT).select("p_partkey", numbers.parse_price("raw_price").cast("decimal(18,4)").alias("price"))


DAY_TEXT = """
SELECT o_orderkey,
  CASE o_orderkey % 6 WHEN 0 THEN d || ' ' WHEN 1 THEN substr(d, 9, 2) || '-' || substr(d, 6, 2) || '-' || substr(d, 1, 4)
       WHEN 2 THEN ' ' || replace(d, '-', '/') WHEN 3 THEN 'junk' WHEN 4 THEN ' ' ELSE NULL END AS raw_day
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) x"""


@query(
    "date_multi_format",
    f"""WITH src AS ({plain(DAY_TEXT)})
SELECT o_orderkey, CAST(coalesce(try_strptime(trim(raw_day, {WS}), '%Y-%m-%d'),
  try_strptime(trim(raw_day, {WS}), '%d-%m-%Y'), try_strptime(trim(raw_day, {WS}), '%Y/%m/%d')) AS DATE) AS day
FROM src""",
)
def date_multi_format(src):
    return src.sql(DAY_TEXT).select("o_orderkey", dates.parse_date("raw_day").alias("day"))


KEY_TEXT = """
SELECT o_orderkey,
  CASE o_orderkey % 6 WHEN 0 THEN 'k' || CAST(o_custkey AS STRING) WHEN 1 THEN ' ' || CAST(o_custkey AS STRING) || ' '
       WHEN 2 THEN CAST(o_custkey AS STRING) || '.5' WHEN 3 THEN NULL WHEN 4 THEN CAST(o_custkey AS STRING) || chr(10)
       ELSE CAST(o_custkey AS STRING) END AS raw_key,
  CASE o_orderkey % 7 WHEN 0 THEN ' ' || chr(9) WHEN 1 THEN NULL ELSE o_orderpriority END AS raw_name
FROM {orders}"""


@query(
    "safe_int",
    f"""WITH src AS ({plain(KEY_TEXT)})
SELECT o_orderkey, CASE WHEN regexp_full_match(trim(raw_key, {WS} || chr(10)), '[0-9]+')
  THEN CAST(trim(raw_key, {WS} || chr(10)) AS BIGINT) END AS custkey FROM src""",
)
def safe_int(src):
    return src.sql(KEY_TEXT).select("o_orderkey", numbers.safe_long("raw_key").alias("custkey"))


@query(
    "numeric_key_filter",
    f"""WITH src AS ({plain(KEY_TEXT)})
SELECT o_orderkey, CAST(raw_key AS BIGINT) AS custkey FROM src
WHERE regexp_full_match(raw_key, '[0-9]+') AND raw_name IS NOT NULL AND trim(raw_name, {WS}) <> ''""",
)
def numeric_key_filter(src):
    usable = src.sql(KEY_TEXT).where(text.is_digits("raw_key") & text.is_present("raw_name"))
    return usable.select("o_orderkey", numbers.hard_long("raw_key").alias("custkey"))


@query(
    "not_null_check",
    f"""WITH src AS ({plain(KEY_TEXT)})
SELECT 'raw_key' AS column_name, count(*) - count(raw_key) AS n_nulls FROM src
UNION ALL SELECT 'raw_name', count(*) - count(raw_name) FROM src
UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey) FROM src""",
)
def not_null_check(src):
    return validation.null_counts(src.sql(KEY_TEXT), ["raw_key", "raw_name", "o_orderkey"])


LINE_SCORES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity * 2) AS INT) AS score,
  CAST(round(l_discount * 1000) AS INT) AS attendance
FROM {lineitem}"""

_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "score_band",
    f"""WITH src AS ({plain(LINE_SCORES)}), graded AS (
SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C'
  WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM src)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, grade,
  CASE WHEN grade = 'A' THEN 'Excellent Performance!' WHEN grade IN ('B', 'C') THEN 'Good Performance.'
       WHEN grade = 'D' THEN 'Needs Improvement.' ELSE 'Fail. Please retake the course.' END AS remark
FROM graded""",
)
def score_band(src):
    graded = src.sql(LINE_SCORES).withColumn("grade", rules.band("score"))
    return graded.select(*_LINE, "grade", rules.label_map("grade").alias("remark"))


@query(
    "eligibility",
    f"""WITH src AS ({plain(LINE_SCORES)})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, score >= 50 AND attendance >= 75 AS is_eligible,
  CASE WHEN score >= 50 AND attendance >= 75
       THEN 'Eligible for graduation. Attendance: ' || attendance || '%, Score: ' || score
       WHEN score >= 50 THEN 'Not eligible due to low attendance. Attendance: ' || attendance || '%'
       ELSE 'Not eligible due to low score. Score: ' || score END AS reason,
  'Score: ' || score || '. Status: ' || CASE WHEN score >= 50 THEN 'PASSED' ELSE 'FAILED' END AS line
FROM src""",
)
def eligibility(src):
    pair = ("score", "attendance")
    return src.sql(LINE_SCORES).select(
        *_LINE,
        rules.eligible(*pair).alias("is_eligible"),
        rules.eligibility_reason(*pair).alias("reason"),
        rules.pass_line("score").alias("line"),
    )


TWO_SCORES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 9 = 0 THEN -CAST(l_quantity AS DECIMAL(10,2)) ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS theory,
  CAST(round(l_discount * 100) AS DECIMAL(10,2)) AS lab
FROM {lineitem}"""


@query(
    "weighted_score",
    f"""WITH src AS ({plain(TWO_SCORES)})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN theory >= 0 AND lab >= 0 THEN CAST(theory * 0.60 + lab * 0.40 AS DECIMAL(18,4)) END AS score
FROM src""",
)
def weighted_score(src):
    score = rules.weighted_score("theory", "lab", strict=False)
    return src.sql(TWO_SCORES).select(*_LINE, score.cast("decimal(18,4)").alias("score"))


CUSTOMER_AGE = """
SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(round(abs(c_acctbal)) AS BIGINT) % 70 END AS age
FROM {customer}"""


@query(
    "rule_violations",
    f"""WITH src AS ({plain(CUSTOMER_AGE)})
SELECT 'Student is underage for this course. Age provided: ' || age || '. Minimum required age: 18. ' ||
  'Hint: enroll the student in a junior level course instead.' AS message, count(*) AS n_rows
FROM src WHERE age < 18 GROUP BY age""",
)
def rule_violations(src):
    violating = src.sql(CUSTOMER_AGE).where(F.col("age") < rules.MINIMUM_AGE)
    return violating.groupBy(rules.underage_message("age").alias("message")).agg(F.count(F.lit(1)).alias("n_rows"))


UNIT_PRICE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS amount,
  CASE WHEN l_partkey % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS divisor,
  CASE WHEN l_suppkey % 5 = 0 THEN 'NotANumber' ELSE CAST(l_suppkey AS STRING) END AS raw_number
FROM {lineitem}"""


@query(
    "safe_divide_fallback",
    f"""WITH src AS ({plain(UNIT_PRICE)})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN divisor = 0 THEN CAST(0 AS DOUBLE) ELSE amount / divisor END AS unit_price,
  coalesce(try_cast(raw_number AS BIGINT), -1) AS number
FROM src""",
)
def safe_divide_fallback(src):
    return src.sql(UNIT_PRICE).select(
        *_LINE,
        numbers.divide_or("amount", "divisor").alias("unit_price"),
        numbers.cast_or("raw_number", "bigint", -1).alias("number"),
    )


EVENT_MESSAGE = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'division by zero: ' || props WHEN 'signup' THEN NULL
  ELSE 'Bad int64 value: ' || props END AS error_message
FROM {events}"""


@query(
    "error_classify",
    f"""WITH src AS ({plain(EVENT_MESSAGE)})
SELECT event_id, CASE WHEN strpos(error_message, 'division by zero') > 0 THEN 'An error occurred: Cannot divide by zero!'
  WHEN error_message IS NOT NULL THEN 'An unexpected error occurred.' END AS error_class
FROM src""",
)
def error_classify(src):
    return src.sql(EVENT_MESSAGE).select("event_id", rules.error_class("error_message").alias("error_class"))


@query(
    "format_rows",
    "SELECT p_partkey, 'Part: ' || p_name || ', Size: ' || coalesce(CAST(p_size AS VARCHAR), 'NULL') || ' cm' AS line FROM part",
)
def format_rows(src):
    return rows.format_rows(src.part, "Part: %s, Size: %s cm", "p_name", "p_size").select("p_partkey", "line")


@query(
    "gen_sequence",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'up' AS direction,
  CAST(unnest(range(1, l_linenumber + 1, 2)) AS BIGINT) AS i FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'down',
  CAST(unnest(range(l_linenumber, 0, -1)) AS BIGINT) FROM lineitem""",
)
def gen_sequence(src):
    lines = src.lineitem.select(*_LINE, F.col("l_linenumber").cast("bigint").alias("n"))
    one = F.lit(1).cast("bigint")
    up = rows.explode_range(lines.withColumn("direction", F.lit("up")), one, F.col("n"), F.lit(2).cast("bigint"), "i")
    down = rows.explode_range(lines.withColumn("direction", F.lit("down")), F.col("n"), one, F.lit(-1).cast("bigint"), "i")
    return up.unionByName(down).drop("n")


@query(
    "loop_skip_stop",
    """WITH halt AS (SELECT user_id AS u, min(event_id) AS stop_at FROM events
  WHERE event_type = 'purchase' AND value >= 20 GROUP BY user_id)
SELECT event_id, user_id, event_type FROM events LEFT JOIN halt ON user_id = u
WHERE event_type <> 'error' AND (stop_at IS NULL OR event_id < stop_at)""",
)
def loop_skip_stop(src):
    events = src.events.select("event_id", "user_id", "event_type", "value")
    halt = (F.col("event_type") == "purchase") & (F.col("value") >= 20)
    processed = rows.skip_and_stop(events, ["user_id"], "event_id", F.col("event_type") == "error", halt)
    return processed.select("event_id", "user_id", "event_type")


@query(
    "param_filter",
    """SELECT event_id, 'Event ' || event_id || ' by user ' || user_id AS line FROM events
WHERE event_type = 'purchase' AND user_id >= 10""",
)
def param_filter(src):
    wanted = rows.where_params(src.events, equals={"event_type": "purchase"}, at_least={"user_id": 10})
    return rows.format_rows(wanted, "Event %s by user %s", "event_id", "user_id").select("event_id", "line")


GRADED = """
SELECT c_custkey AS s_id, c_name AS s_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS s_grade
FROM {customer}"""


@query(
    "table_function",
    f"""WITH src AS ({plain(GRADED)})
SELECT s_id, s_name, CAST(s_grade AS DECIMAL(18,2)) AS s_grade FROM src WHERE s_grade >= 5000""",
)
def table_function(src):
    src.sql(GRADED).createOrReplaceTempView("graded_customers")
    sql.register_high_performers(src.spark, "graded_customers")
    return src.spark.sql(
        "SELECT s_id, s_name, CAST(s_grade AS DECIMAL(18,2)) AS s_grade FROM get_high_performers(5000)"
    )


SHOP_TEXT = """
SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN ' Female' WHEN 1 THEN 'M' WHEN 2 THEN NULL ELSE 'unknown' END AS raw_gender,
  '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS raw_price,
  replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/') AS raw_day,
  CAST(o_custkey % 100 AS INT) AS theory, CAST(o_orderkey % 100 AS INT) AS lab
FROM {orders}"""


@query(
    "sql_functions",
    f"""WITH src AS ({plain(SHOP_TEXT)})
SELECT o_orderkey, CASE lower(trim(raw_gender)) WHEN 'female' THEN 'Female' WHEN 'm' THEN 'Male' ELSE 'n/a' END AS gender,
  CAST(replace(raw_price, '$', '') AS DECIMAL(18,4)) AS price, CAST(strptime(raw_day, '%Y/%m/%d') AS DATE) AS day,
  CAST(theory * 0.60 + lab * 0.40 AS DECIMAL(18,4)) AS score
FROM src""",
)
def sql_functions(src):
    sql.register(src.spark)
    src.sql(SHOP_TEXT).createOrReplaceTempView("shop_text")
    return src.spark.sql(
        "SELECT o_orderkey, clean_gender(raw_gender) AS gender, CAST(clean_price(raw_price) AS DECIMAL(18,4)) AS price, "
        "parse_date_safe(raw_day) AS day, CAST(calculate_final_score(theory, lab) AS DECIMAL(18,4)) AS score FROM shop_text"
    )


@query(
    "lookup_with_defaults",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN -1 ELSE l.quality END AS quality,
  CASE WHEN l.doc_id IS NULL THEN 'Inactive' ELSE 'Active' END AS status,
  CAST(CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE d.n_chars + 0.2 END AS DECIMAL(18,1)) AS score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def with_defaults(src):
    looked = lookup_with_defaults(
        src.documents.select("doc_id", "n_chars"), src.labels, {"doc_id": "doc_id"}, {"quality": "quality"}, {"quality": -1}
    )
    base = F.col("n_chars").cast("decimal(17,1)")
    return looked.select(
        "doc_id",
        "quality",
        F.when(F.col("_found"), "Active").otherwise("Inactive").alias("status"),
        F.when(F.col("_found"), base + F.lit("0.2").cast("decimal(2,1)")).otherwise(base).cast("decimal(18,1)").alias("score"),
    )
