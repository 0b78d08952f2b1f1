"""Layer builds and jobs on small landing files with every kind of dirt."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierhouse.plans import bronze, gold, shop, silver
from tierhouse.plans.audit import Audit, Step, load_summary, run_independent, run_step
from tierhouse.plans.run_all import run_all
from tierhouse.schemas import BRONZE, GOLD, LOAD_DAY, LOAD_LOGS, SHOP_BRONZE, SHOP_SILVER, SILVER, STUDENTS, Table, schema_from_file_text
from tierhouse.scratch import written
from tierhouse.sources.csv import read_csv
from tierhouse.sources.warehouse import Warehouse, write_by_month

D = dt.date
RUN_TS = dt.datetime(2014, 1, 31, 23, 0, 0)
AS_OF = D(2014, 1, 31)

FILES = {
    "source_crm/cust_info.csv": """cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date
500,CU00000500, Ann,Field , s,M,2025-10-06
501,CU00000501,Ben ,o-brien,S,f ,2025-10-06
501,CU00000501,Ben,Stone-Late,M,x,2025-10-09
502,CU00000502,Cyd,Brook,,,2025-10-07
,XX1,No,Key,M,M,2025-10-07
""",
    "source_crm/prd_info.csv": """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
7001,OF-DE-BOARD-22,"Board, ""oak"" top",305,Q,2009-08-15,
7002,OF-CH-STOOL,Stool low,88, m,2013-03-10,2001-01-01
7003,OF-CH-STOOL,Stool low,81,M,2008-11-20,
7004,LI-ST-FLOOR-X,Floor light,,T,2012-06-05,
7005,LI-ST-DIM,Dimmer,7,s ,2011-12-24,2010-10-10
7006,PA-XX-GLUE,Glue,,,2007-04-01,
""",
    "source_crm/sales_details.csv": """sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price
A1,STOOL,500,20140103,20140110,20140115,36,3,12
A2,STOOL,501,20140119,20140121,20140130,,4,9
A3,DIM,502,20131130,20131202,20131209,,6,
A4,DIM,500,0,20131202,20131209,18,6,
A5,NOWHERE,500,201401,20140108,20140111,0,5,
A6,FLOOR-X,99999,20140122,20140123,20140128,11,3,-4
A7,FLOOR-X,,20140130,20140202,20140204,21,0,
A8,BOARD-22,501,20140203,20140206,20140209,-8,2,0
""",
    "source_erp/CUST_AZ12.csv": """CID,BDATE,GEN
NASCU00000500,1971-10-06,Male
CU00000501,2099-01-01,Female
NASCU00000502,1971-02-09,F
""",
    "source_erp/LOC_A101.csv": """CID,CNTRY
CU-00000500,DE
CU-00000501,USA
CU-00000502, Canada
""",
    # No newline at the end of the last line.
    "source_erp/PX_CAT_G1V2.csv": """ID,CAT,SUBCAT,MAINTENANCE
LI_ST,Lighting,Standing,Yes
OF_CH,Office,Chairs,No""",
}


@pytest.fixture
def landing(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return f"file://{tmp_path}/landing"


@pytest.fixture
def warehouse(spark, request):
    return Warehouse(spark, request.node.name.replace("[", "_").replace("]", "_").lower()[:40] + "_")


@pytest.fixture
def loaded(warehouse, landing):
    bronze.load(warehouse, landing)
    silver.load(warehouse, RUN_TS, AS_OF)
    return warehouse


def test_bronze_load(warehouse, landing):
    audit = bronze.load(warehouse, landing)
    counts = {r["step_name"]: (r["status"], r["records_loaded"]) for r in audit.rows}
    assert counts == {
        "LOAD_CRM_CUST_INFO": ("SUCCESS", 5),
        "LOAD_CRM_PRD_INFO": ("SUCCESS", 6),
        "LOAD_CRM_SALES_DETAILS": ("SUCCESS", 8),
        "LOAD_ERP_LOC_A101": ("SUCCESS", 3),
        "LOAD_ERP_CUST_AZ12": ("SUCCESS", 3),
        "LOAD_ERP_PX_CAT_G1V2": ("SUCCESS", 2),
    }
    assert all(r["elapsed_seconds"] >= 0 and r["end_time"] >= r["start_time"] for r in audit.rows)
    prd = {r.prd_id: r for r in warehouse.read(BRONZE["crm_prd_info"]).collect()}
    assert prd[7004].prd_cost is None and prd[7005].prd_line == "s " and prd[7004].prd_end_dt is None
    assert prd[7002].prd_start_dt == dt.datetime(2013, 3, 10)
    assert prd[7001].prd_nm == 'Board, "oak" top'
    # A second load replaces, an appending one adds.
    bronze.load(warehouse, landing)
    assert warehouse.read(BRONZE["erp_loc_a101"]).count() == 3
    bronze.load(warehouse, landing, append=True)
    assert warehouse.read(BRONZE["erp_loc_a101"]).count() == 6
    bronze.prepare(warehouse)
    assert all(warehouse.read(t).isEmpty() for t in BRONZE.values())


def test_bad_value_fails_the_load(warehouse, landing, tmp_path):
    path = tmp_path / "landing" / "source_crm/prd_info.csv"
    path.write_text(path.read_text().replace(",81,M,", ",eighty,M,"))
    audit = Audit("bronze.load")
    with pytest.raises(Exception):
        bronze.load(warehouse, landing, audit=audit)
    failed = [r for r in audit.rows if r["status"] == "FAILED"]
    assert [r["step_name"] for r in failed] == ["LOAD_CRM_PRD_INFO"] and failed[0]["error_message"]


def test_quoted_empty_text_is_not_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,""\n2,\n')
    (tmp_path / "b.csv").write_text('k,v\n3,"say ""hi"""\n')
    schema = Table("x", "y", "k bigint, v string").schema
    got = read_csv(spark, f"file://{tmp_path}/*.csv", schema)
    assert rows(got) == [(1, ""), (2, None), (3, 'say "hi"')]


def test_silver_tables(loaded):
    read = lambda n: loaded.read(SILVER[n])
    assert rows(read("crm_cust_info").drop("dwh_create_date")) == [
        (500, "CU00000500", "Ann", "Field", "Single", "Male", D(2025, 10, 6)),
        (501, "CU00000501", "Ben", "Stone-Late", "Married", "n/a", D(2025, 10, 9)),
        (502, "CU00000502", "Cyd", "Brook", "n/a", "n/a", D(2025, 10, 7)),
    ]
    products = {r.prd_id: tuple(r)[1:8] for r in read("crm_prd_info").collect()}
    assert products[7001] == ("OF_DE", "BOARD-22", 'Board, "oak" top', 305, "n/a", D(2009, 8, 15), None)
    assert products[7003][3:] == (81, "Mountain", D(2008, 11, 20), D(2013, 3, 9)) and products[7002][4:] == ("Mountain", D(2013, 3, 10), None)
    assert products[7004][3:5] == (0, "Touring") and products[7005][4] == "Other Sales" and products[7006][3:5] == (0, "n/a")
    sales = {r.sls_ord_num: r for r in read("crm_sales_details").collect()}
    assert {k: (r.sls_sales, r.sls_price) for k, r in sales.items()} == {
        "A1": (36, 12), "A2": (36, 9), "A3": (None, None), "A4": (18, 3),
        "A5": (None, 0), "A6": (12, 3), "A7": (21, None), "A8": (0, -4),
    }
    assert sales["A4"].sls_order_dt is None and sales["A5"].sls_order_dt is None
    assert rows(read("erp_cust_az12").drop("dwh_create_date")) == [
        ("CU00000500", D(1971, 10, 6), "Male"), ("CU00000501", None, "Female"), ("CU00000502", D(1971, 2, 9), "Female"),
    ]
    assert rows(read("erp_loc_a101").drop("dwh_create_date")) == [
        ("CU00000500", "Germany"), ("CU00000501", "United States"), ("CU00000502", "Canada"),
    ]
    stamps = {r[0] for n in SILVER for r in read(n).select("dwh_create_date").distinct().collect()}
    assert stamps == {RUN_TS}


def test_scheduled_silver_options(loaded):
    bronze_rows = loaded.read(BRONZE["crm_cust_info"])
    got = {r.cst_id: r for r in silver.customers(bronze_rows, silver.SCHEDULED).collect()}
    assert len(got) == 3 and got[501].cst_lastname in ("Stone-Late", "O-Brien")


def test_gold_full_create_and_append(loaded):
    gold.load(loaded, RUN_TS, AS_OF)
    assert rows(loaded.read(GOLD["dim_customers"])) == [
        (1, 500, "CU00000500", "Ann", "Field", "Germany", "Single", "Male", D(1971, 10, 6), D(2025, 10, 6)),
        (2, 501, "CU00000501", "Ben", "Stone-Late", "United States", "Married", "Female", None, D(2025, 10, 9)),
        (3, 502, "CU00000502", "Cyd", "Brook", "Canada", "n/a", "Female", D(1971, 2, 9), D(2025, 10, 7)),
    ]
    products = [(r.product_key, r.product_number, r.category) for r in loaded.read(GOLD["dim_products"]).orderBy("product_key").collect()]
    assert products == [
        (1, "GLUE", None), (2, "BOARD-22", None), (3, "DIM", "Lighting"), (4, "FLOOR-X", "Lighting"), (5, "STOOL", "Office"),
    ]
    fact = lambda: {(r.order_number, r.product_key, r.customer_key) for r in loaded.read(GOLD["fact_sales"]).collect()}
    month = {("A1", 5, 1), ("A2", 5, 2), ("A6", 4, None), ("A7", 4, None)}
    assert fact() == month
    gold.load(loaded, RUN_TS, AS_OF, gold.CREATE)
    everything = month | {("A3", 3, 3), ("A4", 3, 1), ("A5", None, 1), ("A8", 2, 2)}
    assert fact() == everything and loaded.read(GOLD["fact_sales"]).count() == 8

    # Nothing new: the guarded append adds nothing, the plain one adds it all again.
    gold.load(loaded, RUN_TS, AS_OF, gold.GoldOptions("append", "loaded_today", dedupe_existing=True))
    assert (loaded.read(GOLD["dim_customers"]).count(), loaded.read(GOLD["fact_sales"]).count()) == (3, 8)
    gold.load(loaded, RUN_TS, AS_OF, gold.APPEND)
    keys = [r.customer_key for r in loaded.read(GOLD["dim_customers"]).orderBy("customer_key").collect()]
    assert keys == [1, 2, 3, 4, 5, 6]
    # Every lookup now hits two rows of each dimension.
    assert loaded.read(GOLD["fact_sales"]).count() > 16


def test_append_takes_only_rows_stamped_that_day(loaded):
    gold.load(loaded, RUN_TS, D(2014, 2, 1), gold.APPEND)
    assert loaded.read(GOLD["dim_customers"]).isEmpty() and loaded.read(GOLD["fact_sales"]).isEmpty()
    gold.load(loaded, RUN_TS, AS_OF, gold.APPEND)
    assert loaded.read(GOLD["dim_customers"]).count() == 3


def test_run_all(warehouse, landing):
    audit = run_all(warehouse, landing, RUN_TS, AS_OF)
    assert [r["status"] for r in audit.rows] == ["SUCCESS"] * 15
    assert warehouse.read(GOLD["fact_sales"]).count() == 4
    logged = warehouse.read(LOAD_LOGS).where(F.col("run_id") == audit.run_id)
    assert logged.count() == 15 and logged.where("log_id IS NULL OR elapsed_seconds < 0").isEmpty()


def test_failed_layer_is_logged_and_raised(warehouse, landing, tmp_path):
    (tmp_path / "landing" / "source_erp/PX_CAT_G1V2.csv").write_text("a\n\"x")
    path = tmp_path / "landing" / "source_crm/sales_details.csv"
    path.write_text(path.read_text().replace("20140103,20140110", "20141345,20140110"))
    with pytest.raises(Exception):
        run_all(warehouse, landing, RUN_TS, AS_OF)
    assert warehouse.read(LOAD_LOGS).where("status = 'FAILED'").count() >= 1


# Padded and single names, three date forms, `free`, odd quantities: our own rows, with results worked out by hand.
CUSTOMERS = [
    ("7", " Uma Lindt", " Uma@Example.NET", " f", "2021/02/03"),
    ("8", "Viktor", "vik@example.net", "Male", "04-05-2021"),
    ("9", "Wanda van Dam ", None, None, "2021-06-07"),
    ("x9", "No Number", "n@example.net", "m", "2021-01-01"),
    ("10", "   ", "blank@example.net", "m", "2021-01-01"),
]
PRODUCTS = [
    ("30", " Kettle ", "Kitchen", "$19.95"),
    ("31", "Rope 10m", " Garden ", " 7.125 "),
    ("32", "Sample", "Misc", "free"),
    ("33", " ", "Misc", "1"),
    ("34", "Unpriced", None, "ask us"),
]
SALES = [
    ("900", "7", "30", " 3 ", "2022-01-31"),
    ("901", "8 ", "31", "8", "01-02-2022"),
    ("902", "9", "32", "5", "2022/02/02"),
    ("903", "7", "34", "1", "2022-02-03"),
]
REJECTS = [
    ("910", "10", "30", "1", "2022-02-04"),
    ("911", "8", "33", "1", "2022-02-04"),
    ("912", "8", "30", "two", "2022-02-04"),
    ("913", "8", "30", "-1", "2022-02-04"),
    ("914", "8", "30", "1", "31-31-2022"),
    ("915", None, "77", "two", "never"),
]


def shop_bronze(warehouse, sales):
    for name, data in (("customer", CUSTOMERS), ("products", PRODUCTS), ("sales", sales)):
        table = SHOP_BRONZE[name]
        warehouse.create(table)
        warehouse.overwrite(table, warehouse.spark.createDataFrame(data, table.schema), RUN_TS)


def test_shop(warehouse):
    shop_bronze(warehouse, SALES)
    _, checks, summary = shop.load(warehouse, RUN_TS)
    read = lambda n: warehouse.read(SHOP_SILVER[n])
    assert rows(read("dim_customer").drop("is_active", "updated_at")) == [
        (1, 7, "", "Uma", "uma@example.net", "Female", D(2021, 2, 3)),
        (2, 8, "Viktor", None, "vik@example.net", "Male", D(2021, 5, 4)),
        (3, 9, "Wanda", "van", None, "n/a", D(2021, 6, 7)),
    ]
    assert {(r.is_active, r.updated_at) for r in read("dim_customer").collect()} == {(True, RUN_TS)}
    prices = [(r.product_key, r.prod_id, r.prod_name, r.category, r.price) for r in read("dim_products").orderBy("product_key").collect()]
    assert prices == [
        (1, 30, "Kettle", "Kitchen", Decimal("19.95")), (2, 31, "Rope 10m", "Garden", Decimal("7.125")),
        (3, 32, "Sample", "Misc", Decimal(0)), (4, 34, "Unpriced", None, Decimal(0)),
    ]
    assert rows(read("fact_products_sales").drop("loaded_at")) == [
        (1, 900, 1, 1, 3, Decimal("59.85"), D(2022, 1, 31)),
        (2, 901, 2, 2, 8, Decimal("57"), D(2022, 2, 1)),
        (3, 902, 3, 3, 5, Decimal("0"), D(2022, 2, 2)),
        (4, 903, 1, 4, 1, Decimal("0"), D(2022, 2, 3)),
    ]
    assert read("rejected_sales").isEmpty()
    assert {r.message for r in checks.collect()} == {
        "Check Passed: silver.dim_customer contains 3 records.",
        "Check Passed: silver.dim_products contains 4 records.",
        "Check Passed: silver.fact_products_sales contains 4 records.",
    }
    assert [r.log_message for r in summary.collect()] == [
        ">> STEP: START_PIPELINE         | STATUS: INFO | Pipeline loading sequence initiated.",
        ">> STEP: LOAD_DIM_CUSTOMER      | STATUS: SUCCESS | RECORDS LOADED: 3",
        ">> STEP: LOAD_DIM_PRODUCTS      | STATUS: SUCCESS | RECORDS LOADED: 4",
        ">> STEP: LOAD_FACT_SALES        | STATUS: SUCCESS | RECORDS LOADED: 4",
    ]
    shown = shop.inspect(warehouse)
    assert {k: v.count() for k, v in shown.items()} == {
        "load_logs": 4, "dim_customer": 3, "dim_products": 4, "fact_products_sales": 4,
    }


def test_shop_rejects_with_the_first_reason(warehouse):
    shop_bronze(warehouse, SALES + REJECTS)
    shop.load(warehouse, RUN_TS)
    got = {r.sale_id: r.reject_reason for r in warehouse.read(SHOP_SILVER["rejected_sales"]).collect()}
    assert got == {
        910: "Customer ID 10 does not exist in silver.dim_customer",
        911: "Product ID 33 does not exist in silver.dim_products",
        912: "Invalid quantity value (two)",
        913: "Invalid quantity value (-1)",
        914: "Invalid sale date value (31-31-2022)",
        915: "Customer ID NULL does not exist in silver.dim_customer",
    }
    assert warehouse.read(SHOP_SILVER["fact_products_sales"]).count() == 4


def test_shop_steps_are_isolated(warehouse):
    shop_bronze(warehouse, SALES + [("not a number", "7", "30", "1", "2022-02-04")])
    _, checks, summary = shop.load(warehouse, RUN_TS)
    lines = [r.log_message for r in summary.collect()]
    assert "RECORDS LOADED: 3" in lines[1] and "RECORDS LOADED: 4" in lines[2]
    assert lines[3].startswith(">> STEP: LOAD_FACT_SALES        | STATUS: FAILED | ERROR: ") and "not an integer" in lines[3]
    assert "Check Failed: silver.fact_products_sales has 0 rows!" in {r.message for r in checks.collect()}


def test_steps_fail_fast_or_are_isolated(warehouse):
    def broken():
        raise ZeroDivisionError("division by zero: 10 / 0")

    audit = Audit("p")
    assert run_step(audit, Step("A", broken), isolate=True) is None
    assert run_step(audit, Step("B", lambda: 3), isolate=True) == 3
    with pytest.raises(ZeroDivisionError):
        run_step(audit, Step("C", broken))
    with pytest.raises(ZeroDivisionError):
        run_independent(audit, [Step("D", broken), Step("E", lambda: 1)])
    assert [(r["step_name"], r["status"]) for r in audit.rows] == [
        ("A", "FAILED"), ("B", "SUCCESS"), ("C", "FAILED"), ("D", "FAILED"), ("E", "SUCCESS"),
    ]
    assert audit.rows[0]["error_message"] == "division by zero: 10 / 0" and audit.rows[0]["error_state"] == "ZeroDivisionError"
    audit.flush(warehouse)
    assert load_summary(warehouse.read(LOAD_LOGS), run_id=audit.run_id).count() == 5
    later = F.lit("2100-01-01").cast("timestamp")
    assert load_summary(warehouse.read(LOAD_LOGS), since=later).isEmpty()


def test_tables_defaults_and_replace(warehouse):
    warehouse.create(STUDENTS)
    warehouse.create(STUDENTS)
    df = warehouse.spark.createDataFrame([(1, "a", Decimal(3))], "student_id long, student_name string, score decimal(38,9)")
    assert warehouse.overwrite(STUDENTS, df, RUN_TS) == 1
    assert warehouse.append(STUDENTS, df, RUN_TS) == 1
    assert warehouse.read(STUDENTS).select("updated_at").distinct().collect()[0][0] == RUN_TS
    twice = warehouse.read(STUDENTS).withColumn("score", F.col("score") * 2)
    assert warehouse.overwrite(STUDENTS, twice, RUN_TS) == 2
    assert {r.score for r in warehouse.read(STUDENTS).collect()} == {Decimal(6)}
    with pytest.raises(Exception, match="NULL in required column student_name"):
        warehouse.append(STUDENTS, df.withColumn("student_name", F.lit(None).cast("string")), RUN_TS)
    warehouse.truncate(STUDENTS)
    assert warehouse.read(STUDENTS).isEmpty()
    warehouse.create(STUDENTS, replace=True)
    assert warehouse.read(STUDENTS).columns == STUDENTS.columns


def test_schema_files():
    fields = '[{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "NUMERIC"}]'
    got = schema_from_file_text(fields)
    assert got.simpleString() == "struct<a:bigint,b:decimal(38,9)>" and not got["a"].nullable
    assert schema_from_file_text(got.json()) == got


def test_fact_by_month_prunes(spark, loaded, tmp_path):
    gold.load(loaded, RUN_TS, AS_OF, gold.CREATE)
    fact = loaded.read(GOLD["fact_sales"])
    path = f"file://{tmp_path}/fact"
    write_by_month(fact, path, "order_date", ["customer_key", "product_key"])
    for back in (spark.read.parquet(path), fact):
        assert back.count() == 8
        january = back.where(F.col("order_month") == F.lit(D(2014, 1, 1)))
        plan = january._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_month" in plan and january.count() == 4


def test_month_load_reads_one_partition(loaded):
    lines = gold.fact_slice(loaded.read(SILVER["crm_sales_details"]), "month", AS_OF)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sls_order_dt), GreaterThanOrEqual(sls_order_dt" in plan
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert lines.count() == 4
    gold.load(loaded, RUN_TS, D(2031, 5, 5))
    assert loaded.read(GOLD["fact_sales"]).isEmpty()


def _students(warehouse, n):
    rows = warehouse.spark.range(n).select(F.col("id").alias("student_id"), F.lit("a").alias("student_name"))
    return rows.withColumn("score", F.lit(1).cast("decimal(38,9)"))


def test_failed_reload_leaves_the_table(warehouse):
    df = _students(warehouse, 1000)
    warehouse.overwrite(STUDENTS, df, RUN_TS)
    bad = df.withColumn("student_name", F.when(F.col("student_id") < 999, F.col("student_name")))
    for reload in (warehouse.overwrite, warehouse.create_as):
        with pytest.raises(Exception, match="NULL in required column student_name"):
            reload(STUDENTS, bad, RUN_TS)
        assert warehouse.read(STUDENTS).count() == 1000
    assert warehouse.overwrite(STUDENTS, df.limit(10), RUN_TS) == 10 and warehouse.read(STUDENTS).count() == 10


def test_readers_never_see_an_empty_table(warehouse):
    import threading

    df = _students(warehouse, 500)
    warehouse.overwrite(STUDENTS, df, RUN_TS)
    counts, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.append(warehouse.read(STUDENTS).count())
            except Exception as e:  # a scan planned on the version that is being replaced
                assert "FILE_NOT_EXIST" in str(e) or "does not exist" in str(e) or "PATH_NOT_FOUND" in str(e)

    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(4):
        warehouse.overwrite(STUDENTS, df, RUN_TS)
    stop.set()
    reader.join()
    assert counts and set(counts) == {500}


def test_append_of_a_day_keeps_equal_lines(loaded):
    """Two equal lines of one order with an unknown product are two lines, however often the day is appended."""
    line = written(loaded.read(SILVER["crm_sales_details"]).where("sls_ord_num = 'A5'").drop("order_month"), "line")
    loaded.append(SILVER["crm_sales_details"], line, RUN_TS)
    for _ in range(2):
        gold.load(loaded, RUN_TS, AS_OF, gold.GoldOptions("append", "loaded_today", dedupe_existing=True))
        fact = loaded.read(GOLD["fact_sales"])
        assert (fact.count(), fact.where("order_number = 'A5'").count()) == (9, 2)


def test_an_append_reads_its_day_its_months_and_nothing_else(loaded):
    gold.load(loaded, RUN_TS, AS_OF, gold.CREATE)
    scan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for table in (SILVER["crm_sales_details"], SILVER["crm_cust_info"], SILVER["crm_prd_info"]):
        today = loaded.read_day(table, AS_OF)
        assert f"({LOAD_DAY}#" in scan(today).split("PartitionFilters: ")[1].split("PushedFilters")[0] and today.columns == table.columns
        assert today.count() == loaded.read(table).count() and loaded.read_day(table, D(2014, 2, 1)).isEmpty()
    fact = loaded.read(GOLD["fact_sales"])
    columns = [c for c in fact.columns if c != "order_month"]
    lines = written(fact.where("order_number IN ('A1', 'A3', 'A4')").select(columns), "lines")
    again = gold.missing_lines(lines.unionAll(lines.where("order_number = 'A1'")), fact)
    months = next(f for f in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", scan(again)) if "order_month" in f)
    assert "2013-11-01" in months and "2014-01-01" in months and "2014-02-01" not in months
    assert [r.order_number for r in again.collect()] == ["A1"]  # one more of it than the fact has


def test_lines_of_new_orders_are_not_compared_with_the_fact(loaded):
    gold.load(loaded, RUN_TS, AS_OF, gold.CREATE)
    fact = loaded.read(GOLD["fact_sales"])
    lines = written(fact.drop("order_month").withColumn("order_number", F.concat(F.lit("new "), "order_number")), "lines")
    new = gold.missing_lines(lines, fact)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "fact_sales" not in plan
    assert rows(new) == rows(lines)


def test_an_order_without_number_or_date_is_compared_too(loaded):
    gold.load(loaded, RUN_TS, AS_OF, gold.CREATE)
    fact = loaded.read(GOLD["fact_sales"])
    bare = lambda c: F.lit(None).cast(fact.schema[c].dataType).alias(c) if c in ("order_number", "order_date", "order_month") else F.col(c)
    nameless = written(fact.limit(1).select(*map(bare, fact.columns)), "nameless")
    lines = nameless.unionAll(nameless).drop("order_month")
    assert gold.missing_lines(lines, fact).count() == 2
    assert gold.missing_lines(lines, fact.unionAll(nameless)).count() == 1
    orders = lines.select("order_number", "order_date")
    assert gold.missing_lines(lines, fact.unionAll(nameless).unionAll(nameless), orders).isEmpty()


def test_a_repeated_append_replaces_its_own_rows(loaded):
    df = _students(loaded, 5)
    loaded.overwrite(STUDENTS, df, RUN_TS)
    for n in (3, 3, 2):
        loaded.append(STUDENTS, df.limit(n), RUN_TS, run_id="007")
        assert loaded.read(STUDENTS).count() == 5 + n
    loaded.append(STUDENTS, df, RUN_TS, run_id="7")
    assert loaded.read(STUDENTS).count() == 12 and loaded.read(STUDENTS, besides="007").count() == 10
    gold.load(loaded, RUN_TS, D(2001, 1, 1), gold.CREATE)
    again = gold.GoldOptions("append", "loaded_today", run_id="retry")
    seen = set()
    for _ in range(2):  # the same keys and lines, once
        gold.load(loaded, RUN_TS, AS_OF, again)
        dims = rows(loaded.read(GOLD["dim_customers"]).select("customer_key", "customer_id"))
        seen.add((tuple(dims), loaded.read(GOLD["fact_sales"]).count()))
    assert len(seen) == 1 and [k for k, _ in dims] == [1, 2, 3, 4, 5, 6]


def test_a_reader_outlives_one_reload(warehouse):
    df = _students(warehouse, 100)
    warehouse.overwrite(STUDENTS, df, RUN_TS)
    opened = warehouse.read(STUDENTS)
    assert opened.agg(F.max("student_id")).first()[0] == 99  # planned, its files known
    warehouse.overwrite(STUDENTS, df.limit(10), RUN_TS)
    assert opened.count() == 100 and warehouse.read(STUDENTS).count() == 10
    warehouse.overwrite(STUDENTS, df.limit(5), RUN_TS)
    path, system = warehouse._folder(warehouse._versions(STUDENTS))
    assert len(system.listStatus(path)) == 2  # this version and the last


def test_a_cached_table_is_reloaded(warehouse):
    df = _students(warehouse, 100)
    warehouse.overwrite(STUDENTS, df, RUN_TS)
    name = warehouse.name(STUDENTS)
    warehouse.spark.catalog.cacheTable(name)
    try:
        assert warehouse.read(STUDENTS).count() == 100
        warehouse.overwrite(STUDENTS, df.limit(7), RUN_TS)
        assert warehouse.read(STUDENTS).count() == 7 and warehouse.spark.table(name).count() == 7
        warehouse.append(STUDENTS, df.limit(2), RUN_TS)
        assert warehouse.read(STUDENTS).count() == 9
    finally:
        warehouse.spark.catalog.uncacheTable(name)
    warehouse.overwrite(STUDENTS, df.limit(5), RUN_TS)
    assert warehouse.read(STUDENTS).count() == 5


def test_a_layer_called_alone_keeps_its_log(warehouse, landing, tmp_path):
    audit = bronze.load(warehouse, landing)
    assert warehouse.read(LOAD_LOGS).where(F.col("run_id") == audit.run_id).count() == 6
    path = tmp_path / "landing" / "source_crm/prd_info.csv"
    path.write_text(path.read_text().replace(",81,M,", ",eighty,M,"))
    with pytest.raises(Exception):
        bronze.load(warehouse, landing)
    assert warehouse.read(LOAD_LOGS).where("status = 'FAILED'").count() == 1
    assert warehouse.read(BRONZE["crm_prd_info"]).count() == 6
