"""Whole loads into warehouse tables below the scratch folder: reloads, manifest, log, appends."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierhouse.functions.dates import seconds_between
from tierhouse.operators.keys import continue_keys
from tierhouse.operators.validation import column_counts, guard_not_null
from tierhouse.plans import bronze, gold, silver
from tierhouse.plans.audit import FAILED, INFO, SUCCESS, Audit, Step, load_summary, logged, run_independent
from tierhouse.queries import layers
from tierhouse.queries.registry import query
from tierhouse.schemas import LOAD_LOGS, SILVER, Table
from tierhouse.scratch import scratch_path
from tierhouse.sources.csv import Landing, write_csv
from tierhouse.sources.warehouse import Warehouse

TODAY = datetime(1998, 7, 15, 12, 0, 0, tzinfo=timezone.utc)


def _warehouse(src) -> Warehouse:
    return Warehouse(src.spark, f"q{uuid.uuid4().hex[:10]}_", scratch_path(src.spark, "warehouse"))


_CUSTOMERS = Table(
    "silver", "reloaded", "c_custkey bigint, c_name string, c_mktsegment string", not_null=("c_mktsegment",)
)


@query(
    "full_reload",
    """SELECT 'after failure' AS step, c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT 'after reload', c_custkey, upper(c_name), c_mktsegment FROM customer WHERE c_nationkey < 12""",
)
def full_reload(src):
    """A good load, one that fails on its last rows, what readers then see, and a good reload."""
    warehouse, rows = _warehouse(src), src.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    warehouse.overwrite(_CUSTOMERS, rows, TODAY)
    try:
        warehouse.overwrite(_CUSTOMERS, rows.withColumn("c_mktsegment", F.when(F.col("c_nationkey") < 24, F.col("c_mktsegment"))), TODAY)
    except PySparkException as error:
        if "NULL in required column" not in str(error):
            raise
    copy = Table("silver", "seen", _CUSTOMERS.ddl)
    warehouse.overwrite(copy, warehouse.read(_CUSTOMERS), TODAY)
    warehouse.overwrite(_CUSTOMERS, rows.where("c_nationkey < 12").withColumn("c_name", F.upper("c_name")), TODAY)
    seen = warehouse.read(copy).select(F.lit("after failure").alias("step"), "*")
    return seen.unionByName(warehouse.read(_CUSTOMERS).select(F.lit("after reload").alias("step"), "*"))


_LANDED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "region": ("r_regionkey", "r_name"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}


@query(
    "src_manifest",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct FROM {t}"
        for t, columns in _LANDED.items()
        for c in columns
    ),
)
def src_manifest(src):
    """Eight tables as landing files, loaded by manifest; every value is parsed and counted."""
    warehouse, landing, manifest = _warehouse(src), scratch_path(src.spark, "landing"), []
    for name in _LANDED:
        table = getattr(src, name)
        write_csv(table, f"{landing}/{name}")
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
        manifest.append(Landing(name, Table("bronze", name, ddl)))
    with logged(warehouse, "bronze.load", None) as audit:
        bronze.load(warehouse, landing, manifest, audit=audit)
    out = None
    for entry in manifest:
        for part in column_counts(warehouse.read(entry.table), _LANDED[entry.table.name]):
            part = part.select(F.lit(entry.table.name).alias("table_name"), "*")
            out = part if out is None else out.unionByName(part)
    return out


_STEPS = """SELECT * FROM (VALUES (0, 'first', 'INFO', 'LOAD_REGION'), (1, 'first', 'SUCCESS', 'LOAD_NATION'),
  (0, 'second', 'FAILED', 'LOAD_PART'), (1, 'second', 'SUCCESS', 'LOAD_ORDERS')) v(seq, run, status, step)"""


@query(
    "load_summary",
    f"""WITH steps AS ({_STEPS}), counts(step, n) AS (SELECT 'LOAD_NATION', count(*) FROM nation UNION ALL SELECT 'LOAD_PART', count(*) FROM part
  UNION ALL SELECT 'LOAD_ORDERS', count(*) FROM orders UNION ALL SELECT 'LOAD_REGION', count(*) FROM region),
lines AS (SELECT run, seq, '>> STEP: ' || rpad(step, 22, ' ') || ' | STATUS: ' || status || CASE status
  WHEN 'SUCCESS' THEN ' | RECORDS LOADED: ' || n WHEN 'FAILED' THEN ' | ERROR: lost ' || n || ' rows' ELSE ' | started' END AS log_message
  FROM steps JOIN counts USING (step))
SELECT 'of run' AS chosen, CAST(seq + 1 AS INT) AS place, log_message FROM lines WHERE run = 'first'
UNION ALL SELECT 'since', CAST(seq + 1 AS INT), log_message FROM lines WHERE run = 'second'""",
)
def load_summary_lines(src):
    """Two runs write the log; one is read by its id, the other by when it began."""
    warehouse, counts = _warehouse(src), {t: getattr(src, t).count() for t in ("region", "nation", "part", "orders")}
    first, second = Audit("first"), Audit("second")
    first.record("LOAD_REGION", INFO, error_message="started")
    first.record("LOAD_NATION", SUCCESS, counts["nation"])
    began = first.rows[-1]["logged_at"] + timedelta(hours=1)
    second.record("LOAD_PART", FAILED, error_message=f"lost {counts['part']} rows")
    second.record("LOAD_ORDERS", SUCCESS, counts["orders"])
    for row in second.rows:
        row["logged_at"] += timedelta(hours=1)
    run_id = first.run_id
    for audit in (first, second):
        audit.flush(warehouse)
    logs = warehouse.read(LOAD_LOGS)
    out = None
    for name, lines in (("of run", load_summary(logs, run_id=run_id)), ("since", load_summary(logs, since=F.lit(began)))):
        place = F.row_number().over(Window.orderBy("logged_at", "seq"))  # a run has as many lines as steps
        part = lines.select(F.lit(name).alias("chosen"), place.alias("place"), "log_message")
        out = part if out is None else out.unionByName(part)
    return out


@query("not_null_guard", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey IS NOT NULL")
def not_null_guard(src):
    rows = src.orders.select("o_orderkey", "o_custkey", "o_orderdate").where("o_custkey IS NOT NULL")
    return guard_not_null(rows, ["o_orderkey", "o_custkey"])


@query(
    "step_seconds",
    """SELECT l_orderkey, l_linenumber, CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def step_seconds(src):
    lines = src.sql("SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey")
    stamp = lambda c: F.col(c).cast("timestamp")
    return lines.select("l_orderkey", "l_linenumber", seconds_between(stamp("o_orderdate"), stamp("l_shipdate")).alias("seconds"))


# Products first shipped from 1998 on count as loaded today and are appended once more.
@query(
    "gold_append_products",
    f"""WITH dim AS ({layers.G_PRODUCT}), today AS (SELECT * FROM dim WHERE start_date >= DATE '1998-01-01')
SELECT product_key, product_number FROM dim
UNION ALL SELECT (SELECT coalesce(max(product_key), 0) FROM dim) + row_number() OVER (ORDER BY start_date NULLS FIRST, product_number), product_number
FROM today""",
)
def gold_append_products(src):
    dim = layers._gold_products(src)
    today = dim.drop("product_key").where(F.col("start_date") >= "1998-01-01")
    added = continue_keys(today, dim, gold.PRODUCT_ORDER, "product_key")
    return dim.unionByName(added).select("product_key", "product_number")


def _sales_parts(src):
    """The sales lines of two thirds of the orders, and of the rest.

    The parts are told apart by the order, so the filter reaches both sides of
    the join: each line is shuffled for one part only, and none is written before
    it goes to its table.
    """
    lines = silver.sales(src.sql(layers.CRM_SALES))
    late = F.pmod(F.xxhash64("sls_ord_num"), F.lit(3)) == 0
    return lines.where(~late), lines.where(late)


@query("gold_append_fact", layers.G_SALES)
def gold_append_fact(src):
    """The gold load as a job: two thirds of the orders, then the rest as lines of another day."""
    warehouse, yesterday = _warehouse(src), TODAY - timedelta(days=1)
    builds = {
        "crm_cust_info": silver.customers(src.sql(layers.CRM_CUSTOMER)),
        "crm_prd_info": silver.products(src.sql(layers.CRM_PRODUCT)),
        "erp_cust_az12": silver.erp_customers(src.sql(layers.ERP_CUSTOMER), layers.AS_OF),
        "erp_loc_a101": silver.locations(src.sql(layers.ERP_LOCATION)),
        "erp_px_cat_g1v2": silver.categories(src.sql(layers.ERP_CATEGORY)),
    }
    builds["crm_sales_details"], late = _sales_parts(src)
    warehouse.create(*SILVER.values())
    load = lambda name: lambda: warehouse.overwrite(SILVER[name], builds[name], yesterday)
    run_independent(Audit("silver.load"), [Step(name, load(name)) for name in builds], at_once=len(builds))
    gold.load(warehouse, yesterday, yesterday.date(), gold.CREATE)
    warehouse.append(SILVER["crm_sales_details"], late, TODAY)
    gold.load(warehouse, TODAY, TODAY.date(), gold.GoldOptions("append", "loaded_today", dedupe_existing=True, run_id="rest"))
    return warehouse.read(gold.GOLD["fact_sales"]).drop(gold.MONTH)
