"""Compare every query with its SQL on DuckDB: names, types, and the multiset of rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402
from tierhouse.queries.registry import TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _table(arrow):
    names = sorted(arrow.column_names)
    types = {n: str(arrow.schema.field(n).type).replace("large_", "").replace("[ns]", "[us]") for n in names}
    columns = [arrow.column(n).to_pylist() for n in names]
    rows = Counter(zip(*columns)) if columns and not any("list" in t for t in types.values()) else Counter(map(repr, zip(*columns)))
    return names, types, rows


# No Python stage, no cross join and no nested loop in any plan.
FORBIDDEN = (
    "EvalPython MapInPandas MapInArrow FlatMapGroupsIn CartesianProduct BroadcastNestedLoopJoin".split()
)


def compare(spark, con, name: str, folder: str) -> tuple[str, float]:
    """('' or what differs, seconds of the Spark side)."""
    start = time.time()
    df = spark_entry.queries()[name](spark, folder)
    got = df.toArrow()
    seconds = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [node for node in FORBIDDEN if node in plan]
    if found:
        return f"plan has {found}", seconds
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return ("" if got.num_rows else "no rows"), seconds
    want = con.sql(sql).to_arrow_table()
    (gn, gt, gr), (wn, wt, wr) = _table(got), _table(want)
    if gn != wn:
        return f"columns {gn} != {wn}", seconds
    if gt != wt:
        return f"types { {k: (gt[k], wt[k]) for k in gn if gt[k] != wt[k]} }", seconds
    if gr != wr:
        extra, missing = gr - wr, wr - gr
        return f"{sum(gr.values())} vs {sum(wr.values())} rows; extra {list(extra.items())[:3]} missing {list(missing.items())[:3]}", seconds
    return ("" if got.num_rows else "no rows"), seconds


if __name__ == "__main__":
    import tempfile

    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"file://{home}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for query_name in sys.argv[2:] or spark_entry.queries():
        try:
            problem, took = compare(session, con, query_name, folder)
        except Exception as e:
            problem, took = f"{type(e).__name__}: {str(e)[:600]}", 0.0
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {took:6.2f}s {query_name} {problem}", flush=True)
    print(f"{bad} failed")
