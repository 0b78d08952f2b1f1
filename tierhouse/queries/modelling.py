"""Deduplication, history, keys, joins, checks and defaults over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierhouse.functions import dates
from tierhouse.functions.text import decode
from tierhouse.operators import joins, validation
from tierhouse.operators.dedupe import keep_any, keep_latest
from tierhouse.operators.history import current_rows, validity_end
from tierhouse.operators.keys import continue_keys, surrogate_key
from tierhouse.operators.ordered import running_total
from tierhouse.plans.audit import summary_line
from tierhouse.queries.registry import TABLES, plain, query
from tierhouse.schemas import RUN_TS, Table
from tierhouse.sources.warehouse import with_defaults


@query(
    "dedupe_latest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_day
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST) AS n
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) x WHERE n = 1""",
)
def dedupe_latest(src):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    kept = keep_latest(src.lineitem.select(columns), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return kept.withColumn("ship_day", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query(
    "dedupe_any",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_id NULLS FIRST) AS n FROM events WHERE user_id IS NOT NULL) x WHERE n = 1""",
)
def dedupe_any(src):
    return keep_any(src.events.select("user_id", "event_id", "event_type", "value"), ["user_id"])


_RANGES = """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from,
  CAST(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey)
    - INTERVAL 1 DAY AS DATE) AS valid_to
FROM orders"""


def _ranges(src):
    versions = src.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("valid_from"))
    return validity_end(versions, ["o_custkey"], "valid_from", "valid_to", ["o_orderkey"])


@query("scd2_ranges", _RANGES)
def scd2_ranges(src):
    return _ranges(src)


@query("scd2_current", f"SELECT o_custkey, o_orderkey, valid_from FROM ({_RANGES}) r WHERE valid_to IS NULL")
def scd2_current(src):
    return current_rows(_ranges(src), "valid_to").drop("valid_to")


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS order_sk, o_orderkey, o_custkey
FROM orders""",
)
def order_keys(src):
    rows = src.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return surrogate_key(rows, ["o_orderdate", "o_orderkey"], "order_sk").drop("o_orderdate")


def _customers(src):
    return src.customer.select("c_custkey", "c_name", "c_mktsegment")


_TARGET = """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name, c_mktsegment
  FROM customer WHERE c_mktsegment <> 'BUILDING'"""


@query(
    "incremental_append",
    f"""WITH target AS ({_TARGET})
SELECT * FROM target UNION ALL
SELECT (SELECT coalesce(max(customer_key), 0) FROM target) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_mktsegment
FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM target)""",
)
def incremental_append(src):
    target = surrogate_key(_customers(src).where(F.col("c_mktsegment") != "BUILDING"), ["c_custkey"], "customer_key")
    added = continue_keys(_customers(src), target, ["c_custkey"], "customer_key", business_key=["c_custkey"])
    return target.unionByName(added)


@query(
    "incremental_append_all",
    f"""WITH target AS ({_TARGET})
SELECT * FROM target UNION ALL
SELECT (SELECT coalesce(max(customer_key), 0) FROM target) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_mktsegment
FROM customer""",
)
def incremental_append_all(src):
    target = surrogate_key(_customers(src).where(F.col("c_mktsegment") != "BUILDING"), ["c_custkey"], "customer_key")
    return target.unionByName(continue_keys(_customers(src), target, ["c_custkey"], "customer_key"))


_DIM_CUSTOMERS = """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machinery' ELSE 'n/a' END AS segment,
  n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

SEGMENTS = {"BUILDING": "Building", "MACHINERY": "Machinery"}


def customer_dimension(src):
    unique = keep_latest(src.customer, ["c_custkey"], [], tie_break=["c_name", "c_nationkey"])
    with_nation = joins.lookup(
        unique, src.nation, {"c_nationkey": "n_nationkey"}, {"nation": "n_name", "_regionkey": "n_regionkey"}
    )
    with_region = joins.lookup(with_nation, src.region, {"_regionkey": "r_regionkey"}, {"region": "r_name"})
    rows = with_region.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        decode("c_mktsegment", SEGMENTS).alias("segment"),
        "nation",
        "region",
    )
    return surrogate_key(rows, ["customer_id"], "customer_key")


@query("dim_customers_build", _DIM_CUSTOMERS)
def dim_customers_build(src):
    return customer_dimension(src)


_CATEGORY_VALUES = """(VALUES ('STANDARD', 'Core', 'No'), ('PROMO', 'Campaign', 'No'), ('ECONOMY', 'Core', 'No'),
  ('LARGE', 'Bulk', 'Yes'), ('MEDIUM', 'Bulk', 'Yes')) AS c(type_name, category, maintenance)"""

_DIM_PRODUCTS = f"""SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS product_id, p_name AS product_name,
  p_type AS type_name, category, maintenance
FROM part LEFT JOIN {_CATEGORY_VALUES} ON p_type = c.type_name"""


def product_dimension(src):
    categories = src.spark.sql(f"SELECT * FROM {_CATEGORY_VALUES}")
    looked = joins.lookup(
        src.part, categories, {"p_type": "type_name"}, {"category": "category", "maintenance": "maintenance"}, unique=True
    )
    rows = looked.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("type_name"),
        "category",
        "maintenance",
    )
    return surrogate_key(rows, ["product_id"], "product_key")


@query("dim_products_build", _DIM_PRODUCTS)
def dim_products_build(src):
    return product_dimension(src)


_FACT = f"""WITH dim_c AS ({_DIM_CUSTOMERS}), dim_p AS ({_DIM_PRODUCTS}), lines AS (
  SELECT l_orderkey, l_linenumber, o_custkey, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_partkey END AS part_ref,
    CAST(l_shipdate AS DATE) AS ship_day, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, p.product_key, c.customer_key, ship_day, cents
FROM lines LEFT JOIN dim_p p ON part_ref = p.product_id LEFT JOIN dim_c c ON o_custkey = c.customer_id"""

LINES = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_partkey END AS part_ref,
  CAST(l_shipdate AS DATE) AS ship_day, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
FROM {lineitem}"""


def _fact(src, lines):
    with_order = joins.lookup(lines, src.orders, {"l_orderkey": "o_orderkey"}, {"_custkey": "o_custkey"})
    with_product = joins.lookup(
        with_order, product_dimension(src), {"part_ref": "product_id"}, {"product_key": "product_key"}
    )
    with_customer = joins.lookup(
        with_product, customer_dimension(src), {"_custkey": "customer_id"}, {"customer_key": "customer_key"}
    )
    return with_customer.select("l_orderkey", "l_linenumber", "product_key", "customer_key", "ship_day", "cents")


@query("fact_build", _FACT)
def fact_build(src):
    return _fact(src, src.sql(LINES))


@query(
    "fact_month_slice",
    f"""SELECT * FROM ({_FACT}) f WHERE date_trunc('month', ship_day) = date_trunc('month', DATE '1998-07-15')""",
)
def fact_month_slice(src):
    return _fact(src, src.sql(LINES).where(dates.in_month("ship_day", "1998-07-15")))


@query(
    "repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated_keys(src):
    return joins.repeated_keys(src.lineitem, ["l_orderkey", "l_linenumber"])


SHIFTED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1000000000 WHEN o_orderkey % 17 = 0 THEN NULL
  ELSE o_custkey END AS cust_ref
FROM {orders}"""


@query(
    "orphan_check",
    f"""WITH src AS ({plain(SHIFTED)})
SELECT cust_ref AS orphan_key, count(*) AS n_rows FROM src
WHERE cust_ref IS NOT NULL AND cust_ref NOT IN (SELECT c_custkey FROM customer) GROUP BY 1
UNION ALL
SELECT d.doc_id, count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL GROUP BY 1""",
)
def orphan_check(src):
    orders = joins.orphan_counts(src.sql(SHIFTED), src.customer, "cust_ref", "c_custkey")
    documents = joins.orphan_counts(src.documents, src.labels, "doc_id", "doc_id")
    return orders.unionByName(documents)


@query(
    "exists_semi",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
  AND o_orderpriority = '1-URGENT')""",
)
def exists_semi(src):
    urgent = src.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.having_match(src.customer.select("c_custkey", "c_name"), urgent, {"c_custkey": "o_custkey"})


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


def _counts(src):
    return validation.row_counts({t: getattr(src, t) for t in TABLES})


@query(
    "validate_counts",
    f"""SELECT table_name, n_rows, CASE WHEN n_rows = 0 THEN 'Check Failed: ' || table_name || ' has 0 rows!'
  ELSE 'Check Passed: ' || table_name || ' contains ' || n_rows || ' records.' END AS message FROM ({_COUNTS}) c""",
)
def validate_counts(src):
    return validation.non_empty_checks(_counts(src))


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'part', p_partkey, p_name FROM part""",
)
def union_all(src):
    def part(df, kind, key, name):
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(name).alias("name"))

    return (
        part(src.customer, "customer", "c_custkey", "c_name")
        .unionByName(part(src.supplier, "supplier", "s_suppkey", "s_name"))
        .unionByName(part(src.part, "part", "p_partkey", "p_name"))
    )


@query(
    "running_sum",
    """SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id
  ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_cents FROM events""",
)
def running_sum(src):
    events = src.events.select("event_id", "user_id", "ts", "value")
    cents = F.round(F.col("value") * 100).cast("bigint")
    order = [F.col("ts").asc_nulls_first(), F.col("event_id").asc_nulls_first()]
    return running_total(events, ["user_id"], order, cents, "running_cents").drop("ts", "value")


STAMPED = Table(
    "silver",
    "stamped",
    "",
    {"dwh_create_date": RUN_TS, "is_active": True, "records_loaded": 0},
)


@query(
    "defaults_stamp",
    """SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2026-01-02 03:04:05' AS dwh_create_date, TRUE AS is_active,
  0 AS records_loaded FROM customer""",
)
def defaults_stamp(src):
    stamped = with_defaults(_customers(src), STAMPED, "2026-01-02 03:04:05")
    return stamped.withColumn("dwh_create_date", F.col("dwh_create_date").cast("timestamp_ntz"))
