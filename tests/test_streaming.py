import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierhouse.operators.changes import ChangeSpec
from tierhouse.schemas import BRONZE
from tierhouse.streaming.changes import ChangeTable, stream_changes
from tierhouse.streaming.files import ingest_new_files

RUN_TS = "2026-01-02 03:04:05"


def test_each_file_is_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint"
    schema = BRONZE["erp_loc_a101"].schema
    run = lambda **kw: ingest_new_files(spark, f"file://{landing}", schema, out, checkpoint, **kw)
    (landing / "1.csv").write_text("CID,CNTRY\nAW-1,DE\nAW-2,\n")
    run()
    assert rows(spark.read.parquet(out)) == [("AW-1", "DE"), ("AW-2", None)]
    run()
    assert spark.read.parquet(out).count() == 2
    (landing / "2.csv").write_text("CID,CNTRY\nAW-3,US")
    (landing / "3.csv").write_text('CID,CNTRY\n"AW-4","U,S"')
    run(files_per_batch=1)
    assert rows(spark.read.parquet(out)) == [("AW-1", "DE"), ("AW-2", None), ("AW-3", "US"), ("AW-4", "U,S")]


def test_a_bad_value_stops_the_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.csv").write_text("k\nnot a number\n")
    schema = spark.range(0).withColumnRenamed("id", "k").schema
    with pytest.raises(Exception):
        ingest_new_files(spark, f"file://{landing}", schema, f"file://{tmp_path}/o", f"file://{tmp_path}/c")


SPEC = ChangeSpec("id", "score", ("score",), "INSERT_STUDENT", "UPDATE_SCORE", "DELETE_STUDENT", "updated_at")
FEED = "id long, name string, score long, op string, seq long"


def make_table(spark, path, hot_rows=10_000_000):
    base = spark.createDataFrame([(1, "a", 10, None), (2, "b", 20, None)], "id long, name string, score long, updated_at timestamp")
    table = ChangeTable(f"file://{path}/table", base.schema, SPEC, hot_rows)
    table.create(base)
    return table


def state(table, spark):
    return rows(table.current(spark).drop("updated_at"))


def test_changes_follow_the_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table = make_table(spark, tmp_path)
    schema = spark.createDataFrame([], FEED).schema
    run = lambda: stream_changes(spark, f"file://{landing}", schema, table, f"file://{tmp_path}/c", RUN_TS)
    (landing / "1.csv").write_text("h,h,h,h,h\n1,x,11,upsert,1\n3,c,30,upsert,2\n2,,,delete,3\n1,x,11,upsert,4\n")
    run()
    assert state(table, spark) == [(1, "a", 11), (3, "c", 30)]
    (landing / "2.csv").write_text("h,h,h,h,h\n2,back,5,upsert,5\n3,,,delete,6\n9,,,delete,7\n")
    run()
    run()
    assert state(table, spark) == [(1, "a", 11), (2, "back", 5)]
    log = table.log(spark).orderBy("seq").select("seq", "id", "action_performed", "old_score", "new_score", "changed_at")
    stamp = dt.datetime(2026, 1, 2, 3, 4, 5)
    assert [tuple(r) for r in log.collect()] == [
        (1, 1, "UPDATE_SCORE", 10, 11, stamp),
        (2, 3, "INSERT_STUDENT", None, 30, stamp),
        (3, 2, "DELETE_STUDENT", 20, None, stamp),
        (5, 2, "INSERT_STUDENT", None, 5, stamp),
        (6, 3, "DELETE_STUDENT", 30, None, stamp),
        (7, 9, "DELETE_STUDENT", None, None, stamp),
    ]
    other = ChangeTable(f"file://{tmp_path}/rebucketed", table.schema, SPEC, buckets=3)
    table.rebucket(spark, other)
    assert state(other, spark) == state(table, spark)


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    table = make_table(spark, tmp_path)
    feed = lambda *r: spark.createDataFrame(list(r), FEED)
    first = feed((1, "x", 12, "upsert", 1), (2, None, None, "delete", 2))
    second = feed((1, "x", 13, "upsert", 3))
    table.apply(first, 0, RUN_TS)
    table.apply(second, 1, RUN_TS)
    before, log = state(table, spark), rows(table.log(spark))
    table.apply(second, 1, RUN_TS)
    table.apply(first, 0, RUN_TS)
    assert state(table, spark) == before == [(1, "a", 13)] and rows(table.log(spark)) == log


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    table = make_table(spark, tmp_path)
    keys = spark.createDataFrame([(1,)], "id long")
    numbers, touched = table.touched(keys)
    assert len(numbers) == 1 and [r.id for r in touched.join(keys, "id").collect()] == [1]
    scan = touched._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_a_batch_that_fails_half_way_is_repeated(spark, tmp_path, monkeypatch):
    """The state is written, its empty bucket not yet dropped: the same batch again gives the same state and log."""
    from dataclasses import replace

    from tierhouse.streaming import changes

    whole = replace(make_table(spark, tmp_path / "whole"), buckets=3)
    broken = replace(make_table(spark, tmp_path / "broken"), buckets=3)
    for table in (whole, broken):
        table.create(spark.createDataFrame([(1, "a", 10, None), (2, "b", 20, None)], table.schema))
    rows_of = [(1, None, None, "delete", 1), (2, "z", 7, "upsert", 2), (2, None, None, "delete", 3), (5, "e", 50, "upsert", 4)]
    feed = spark.createDataFrame(rows_of, FEED)
    whole.apply(feed, 0, RUN_TS)
    for step in ("_write", "drop"):
        with monkeypatch.context() as patch:
            def fail(*args):
                raise OSError("lost")

            if step == "_write":
                patch.setattr(changes.ChangeTable, "_write", fail)
            else:
                patch.setattr(changes, "drop_path", fail)
            with pytest.raises(OSError):
                broken.apply(feed, 0, RUN_TS)
    broken.apply(feed, 0, "2027-01-01 00:00:00")
    assert state(broken, spark) == state(whole, spark) == [(5, "e", 50)]
    assert rows(broken.log(spark).drop("changed_at")) == rows(whole.log(spark).drop("changed_at"))


def test_many_batches_leave_few_folders_and_no_scratch(spark, tmp_path):
    from dataclasses import replace

    from tierhouse import scratch

    table = replace(make_table(spark, tmp_path), buckets=2, path=f"file://{tmp_path}/other")
    table.create(spark.createDataFrame([(1, "a", 10, None), (2, "b", 20, None)], table.schema))
    want = {1: 10, 2: 20}
    for batch in range(10):
        key = batch % 4 + 1
        op = "delete" if batch % 3 == 2 else "upsert"
        table.apply(spark.createDataFrame([(key, "n", batch, op, batch)], FEED), batch, RUN_TS)
        want = {k: v for k, v in want.items() if k != key} | ({key: batch} if op == "upsert" else {})
        assert len(scratch.listed(spark, table.before_path)) <= 2 and len(scratch.listed(spark, table.state_path)) <= 2
    assert {r.id: r.score for r in table.current(spark).collect()} == want
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch._application_folder(spark))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
    assert not [n for n in left if n.startswith("load-")]


def test_bad_lines_go_to_the_rejects(spark, tmp_path):
    landing, done = tmp_path / "landing", tmp_path / "done"
    landing.mkdir()
    out, rejects, checkpoint = (f"file://{tmp_path}/{n}" for n in ("out", "rejects", "checkpoint"))
    run = lambda: ingest_new_files(
        spark, f"file://{landing}", spark.createDataFrame([], "k long, v string").schema, out, checkpoint, rejects=rejects, archive=f"file://{done}"
    )
    (landing / "1.csv").write_text("k,v\n1,a\nnot a number,b\n2,c,too many\n3,\n")
    run()
    (landing / "2.csv").write_text("k,v\n4,d\n")
    run()
    run()
    good = spark.read.parquet(out).drop("batch")
    assert rows(good) == [(1, "a", "1.csv"), (3, None, "1.csv"), (4, "d", "2.csv")]
    bad = spark.read.parquet(rejects).drop("batch")
    assert rows(bad) == [("2,c,too many", "1.csv"), ("not a number,b", "1.csv")]
    (landing / "3.csv").write_text("k,v\n5,e\n")
    run()
    assert spark.read.parquet(out).count() == 4
    assert {p.name for p in done.rglob("*.csv")} >= {"1.csv"}  # moved once a later batch has begun
