"""Every registered query against its SQL and plan rules (see oracle.py)."""

import datetime as dt
import os

import pytest

import __spark_entry__ as spark_entry
from tests.conftest import rows
from tests.oracle import compare, connect
from tierhouse import queries as registered
from tierhouse.plans import silver
from tierhouse.queries import jobs, layers
from tierhouse.queries.registry import Source

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(registered.oracle_sql())


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_agrees_with_sql(spark, con, name):
    problem, _ = compare(spark, con, name, FOLDER)
    assert not problem


def test_manifest_counts_do_not_hold_all_columns_in_a_task(spark, tmp_path):
    """No row becomes one for each column, which is what several distinct counts in one aggregate do."""
    for table, columns in jobs._LANDED.items():
        values = [tuple([v] * len(columns)) for v in (1, 1, 2, None)]
        spark.createDataFrame(values, ", ".join(f"{c} bigint" for c in columns)).write.parquet(f"{tmp_path}/{table}.parquet")
    counted = registered.queries()["src_manifest"](spark, str(tmp_path))
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    assert rows(counted) == sorted(((t, c, 3, 2) for t, columns in jobs._LANDED.items() for c in columns), key=repr)


def test_parts_of_the_sales_are_told_apart_before_the_join(spark, tmp_path):
    days = "o_orderdate timestamp", "l_shipdate timestamp"
    day = dt.datetime(1997, 5, 4)
    orders = [(k, k % 7, day) for k in range(1, 40)] + [(5, 1, day), (None, 1, day)]
    lines = [(k, k % 5, n, 2.0, 30.0, day) for k in range(1, 45) for n in (1, 2)] + [(None, 1, 1, 2.0, 30.0, day)]
    spark.createDataFrame(orders, f"o_orderkey long, o_custkey long, {days[0]}").write.parquet(f"{tmp_path}/orders.parquet")
    ddl = f"l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, {days[1]}"
    spark.createDataFrame(lines, ddl).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = jobs._sales_parts(Source(spark, str(tmp_path)))
    for part in parts:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert [f.count("xxhash64") for f in plan.split("\n") if "Filter (" in f] == [1, 1]  # on the lines and on the orders
    whole = silver.sales(Source(spark, str(tmp_path)).sql(layers.CRM_SALES))
    assert rows(parts[0].unionAll(parts[1])) == rows(whole) and all(not part.isEmpty() for part in parts)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["customer_key", "customer_id", "customer_name", "segment", "nation", "region"]
    assert df.count() > 0
