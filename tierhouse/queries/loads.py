"""What loads leave behind: row counts, errors, emptied and replaced tables, identifiers, schema files, scratch."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierhouse.plans import bronze, shop
from tierhouse.plans.audit import Audit, Step, run_independent, run_step
from tierhouse.queries import layers
from tierhouse.queries import shop as shop_queries
from tierhouse.queries.registry import oracle_sql, plain, query
from tierhouse.schemas import BRONZE, LOAD_LOGS, SHOP_BRONZE, UUID, Table, schema_from_file_text
from tierhouse.scratch import listed, scratch_path, scratch_scope, written
from tierhouse.sources.csv import read_csv, write_csv
from tierhouse.sources.warehouse import Warehouse

RUN_TS = datetime(1998, 7, 15, 12, 0, 0, tzinfo=timezone.utc)


def _warehouse(src) -> Warehouse:
    return Warehouse(src.spark, f"q{uuid.uuid4().hex[:10]}_", scratch_path(src.spark, "warehouse"))


_ORDERS = Table("bronze", "orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string", not_null=("o_orderstatus",))
_PARTS = Table("bronze", "parts", "p_partkey bigint, p_name string, row_id string", {"row_id": UUID})


@query(
    "written_row_counts",
    """SELECT 'reload' AS step, count(*) AS records_loaded FROM orders
UNION ALL SELECT 'append', count(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'append again', count(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'in the table', count(*) + count(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'after reload', count(*) FILTER (o_orderstatus = 'P') FROM orders""",
)
def written_row_counts(src):
    """The counts that writes report, as the step log holds them, beside a count of the table."""
    warehouse, audit, orders = _warehouse(src), Audit("counts"), src.orders
    finished = orders.where("o_orderstatus = 'F'")
    add = lambda: warehouse.append(_ORDERS, finished, RUN_TS, run_id="finished")
    steps = [
        Step("reload", lambda: warehouse.overwrite(_ORDERS, orders, RUN_TS)),
        Step("append", add),
        Step("append again", add),
        Step("in the table", lambda: warehouse.read(_ORDERS).count()),
        Step("after reload", lambda: warehouse.overwrite(_ORDERS, orders.where("o_orderstatus = 'P'"), RUN_TS)),
    ]
    for step in steps:
        run_step(audit, step)
    audit.flush(warehouse)
    return warehouse.read(LOAD_LOGS).select(F.col("step_name").alias("step"), "records_loaded")


@query(
    "load_errors",
    """SELECT * FROM (VALUES (0, 'BAD_VALUE', 'FAILED', true, 0), (2, 'NULL_STATUS', 'FAILED', true, 0)) v(seq, step_name, status, has_reason, records_loaded)
UNION ALL SELECT 1, 'GOOD', 'SUCCESS', false, count(*) FROM orders
UNION ALL SELECT 3, 'BESIDE_IT', 'SUCCESS', false, count(*) FILTER (o_orderstatus = 'O') FROM orders""",
)
def load_errors(src):
    """Isolated and failing steps: each is in the log with its reason, and the others' rows are loaded."""
    warehouse, audit, orders = _warehouse(src), Audit("errors"), src.orders
    warehouse.create(_ORDERS)
    landing = scratch_path(src.spark, "landing")
    write_csv(orders.select(F.concat(F.lit("no. "), "o_orderkey"), "o_custkey", "o_orderstatus"), landing)
    broken = orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    side = Table("bronze", "open_orders", _ORDERS.ddl)
    run_step(audit, Step("BAD_VALUE", lambda: warehouse.overwrite(_ORDERS, read_csv(src.spark, landing, _ORDERS.schema), RUN_TS)), isolate=True)
    run_step(audit, Step("GOOD", lambda: warehouse.overwrite(_ORDERS, orders, RUN_TS)), isolate=True)
    both = [
        Step("NULL_STATUS", lambda: warehouse.overwrite(_ORDERS, broken, RUN_TS)),
        Step("BESIDE_IT", lambda: warehouse.overwrite(side, orders.where("o_orderstatus = 'O'"), RUN_TS)),
    ]
    try:
        run_independent(audit, both)
    except PySparkException as error:
        if "NULL in required column" not in str(error):
            raise
    audit.flush(warehouse)
    reason = F.coalesce(F.length("error_message") > 0, F.lit(False)) & F.col("error_state").isNotNull()
    return warehouse.read(LOAD_LOGS).select(F.col("seq").cast("int").alias("seq"), "step_name", "status", reason.alias("has_reason"), "records_loaded")


@query(
    "truncate_and_replace",
    """SELECT 'truncated' AS step, o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'replaced', o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""",
)
def truncate_and_replace(src):
    """A table emptied and filled again, then dropped, created anew and filled once more."""
    warehouse, orders, copy = _warehouse(src), src.orders, Table("bronze", "copy", _ORDERS.ddl)
    warehouse.overwrite(_ORDERS, orders, RUN_TS)
    warehouse.truncate(_ORDERS)
    warehouse.append(_ORDERS, orders.where("o_orderstatus = 'P'"), RUN_TS)
    warehouse.overwrite(copy, warehouse.read(_ORDERS), RUN_TS)
    warehouse.create(_ORDERS, replace=True)
    warehouse.append(_ORDERS, orders.where("o_orderstatus = 'F'"), RUN_TS)
    out = warehouse.read(copy).select(F.lit("truncated").alias("step"), "*")
    return out.unionByName(warehouse.read(_ORDERS).select(F.lit("replaced").alias("step"), "*"))


@query(
    "bronze_prepare",
    f"""SELECT 'erp_cust_az12' AS table_name, cid FROM ({plain(layers.ERP_CUSTOMER)}) x WHERE bdate < DATE '1970-01-01'
UNION ALL SELECT 'erp_loc_a101', cid FROM ({plain(layers.ERP_LOCATION)}) y WHERE cntry IS NULL""",
)
def bronze_prepare(src):
    """All landing tables are emptied, whatever they held; what is appended then is all there is."""
    warehouse, people, places = _warehouse(src), src.sql(layers.ERP_CUSTOMER), src.sql(layers.ERP_LOCATION)
    warehouse.overwrite(BRONZE["erp_cust_az12"], people, RUN_TS)
    bronze.prepare(warehouse)
    warehouse.append(BRONZE["erp_cust_az12"], people.where("bdate < DATE '1970-01-01'"), RUN_TS)
    warehouse.append(BRONZE["erp_loc_a101"], places.where("cntry IS NULL"), RUN_TS)
    out = None
    for name in BRONZE:
        rows = warehouse.read(BRONZE[name])
        part = rows.select(F.lit(name).alias("table_name"), F.col(rows.columns[0]).cast("string").alias("cid"))
        out = part if out is None else out.unionByName(part)
    return out


@query("uuid_defaults", "SELECT p_partkey, p_name, true AS is_uuid, 1 AS holders FROM part")
def uuid_defaults(src):
    """Every row gets an identifier of its own, in canonical form."""
    warehouse = _warehouse(src)
    warehouse.overwrite(_PARTS, src.part.select("p_partkey", "p_name"), RUN_TS)
    rows = warehouse.read(_PARTS)
    held = rows.groupBy("row_id").agg(F.count(F.lit(1)).cast("int").alias("holders"))
    shape = F.col("row_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return rows.join(held, "row_id").select("p_partkey", "p_name", shape.alias("is_uuid"), "holders")


@query("schema_file", "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders")
def schema_file(src):
    """Landing files read with a schema that is itself a file."""
    spark, landing, path = src.spark, scratch_path(src.spark, "landing"), scratch_path(src.spark, "schema")
    rows = src.orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderstatus")
    write_csv(rows, landing)
    names = {"bigint": "INT64", "double": "FLOAT64", "date": "DATE", "string": "STRING"}
    fields = [{"name": f.name, "type": names[f.dataType.simpleString()], "mode": "NULLABLE"} for f in rows.schema.fields]
    spark.createDataFrame([(json.dumps(fields),)], "value string").coalesce(1).write.text(path)
    text = "".join(r.value for r in spark.read.text(path).collect())  # one line: a schema
    return read_csv(spark, landing, schema_from_file_text(text))


_STATUS = [("O", "open", 1), ("F", "finished", 2), ("P", None, 3), ("X", "never used", 4)]


@query(
    "literal_rows",
    """SELECT label, place, count(o_orderkey) AS n FROM (VALUES ('O', 'open', 1), ('F', 'finished', 2), ('P', NULL, 3), ('X', 'never used', 4)) v(code, label, place)
LEFT JOIN orders ON o_orderstatus = code GROUP BY label, place""",
)
def literal_rows(src):
    """Rows given in the call, as a table that others join."""
    given = src.spark.createDataFrame(_STATUS, "code string, label string, place int")
    counts = src.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    joined = given.join(counts, F.col("code") == F.col("o_orderstatus"), "left")
    return joined.select("label", "place", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("staging_dropped", "SELECT o_custkey, count(*) AS orders, 0 AS left_over FROM orders GROUP BY o_custkey")
def staging_dropped(src):
    """A load's intermediate tables are gone when it ends, and its result is not."""
    warehouse, table = _warehouse(src), Table("silver", "per_customer", "o_custkey bigint, orders bigint")
    with scratch_scope(src.spark):
        staged = written(src.orders.select("o_custkey"), "staged")
        folder = staged.inputFiles()[0].rsplit("/", 1)[0]
        warehouse.overwrite(table, staged.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")), RUN_TS)
    left = len([n for n, _ in listed(src.spark, folder.rsplit("/", 2)[0]) if n == folder.rsplit("/", 2)[1]])
    return warehouse.read(table).withColumn("left_over", F.lit(left))


@query(
    "shop_inspect",
    f"""SELECT 'dim_customer' AS table_name, count(*) AS n_rows, 8 AS n_columns FROM ({oracle_sql()['shop_dim_customer']}) c
UNION ALL SELECT 'dim_products', count(*), 6 FROM ({oracle_sql()['shop_dim_products']}) p
UNION ALL SELECT 'fact_products_sales', count(*), 8 FROM ({oracle_sql()['fact_accept']}) f
UNION ALL SELECT 'load_logs', 4, 6""",
)
def shop_inspect(src):
    """The whole shop load, then the tables it shows."""
    warehouse = _warehouse(src)
    given = {"customer": shop_queries.CUSTOMER, "products": shop_queries.PRODUCT, "sales": shop_queries.SALES}
    for name, text in given.items():
        warehouse.overwrite(SHOP_BRONZE[name], src.sql(text), RUN_TS)
    shop.load(warehouse, RUN_TS)
    out = None
    for name, shown in shop.inspect(warehouse).items():
        part = shown.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(shown.columns)).alias("n_columns")
        )
        out = part if out is None else out.unionByName(part)
    return out
