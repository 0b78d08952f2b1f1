import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tierhouse.operators import changes, joins, rows as loops, validation
from tierhouse.operators.dedupe import keep_any, keep_latest
from tierhouse.operators.history import current_rows, validity_end
from tierhouse.operators.keys import continue_keys, highest_key, surrogate_key
from tierhouse.operators.ordered import neighbour, range_sequence, running_total
from tierhouse.operators.skew import hot_keys, split_hot
from tierhouse.scratch import drop_scratch, written

D = dt.date


def skewed(spark, n=3000, seed=7):
    """A third of the rows on one key, some on NULL, many ties in the order column."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        draw = rng.random()
        key = 1 if draw < 0.34 else None if draw < 0.44 else rng.randint(2, 200)
        day = None if rng.random() < 0.02 else D(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
        data.append((i, key, day, rng.randint(-50, 50) if rng.random() > 0.05 else None))
    return spark.createDataFrame(data, "id long, k long, day date, v long").repartition(6)


def by_day():
    return [F.col("day").asc_nulls_first(), F.col("id").asc_nulls_first()]


def test_split_hot_is_a_partition_of_the_rows(spark):
    df = skewed(spark)
    cold, hot = split_hot(df, ["k"], 200)
    assert rows(cold.unionByName(hot)) == rows(df)
    assert {r[0] for r in hot.select("k").distinct().collect()} == {1, None}
    assert hot_keys(df, ["k"], 10_000) is None
    assert split_hot(df, ["k"], 10_000)[1] is None


@pytest.fixture
def many_ranges(spark):
    """Range partitions stay apart, so that values really have to cross their borders."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.mark.usefixtures("many_ranges")
@pytest.mark.parametrize("hot_rows", [200, 10_000_000])
@pytest.mark.parametrize("direction", ["next", "previous"])
def test_neighbour_agrees_with_the_plain_window(spark, hot_rows, direction):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy(*by_day())
    step = F.lead if direction == "next" else F.lag
    want = df.select("*", step("id").over(w).alias("n_id"), step("v").over(w).alias("n_v"))
    got = neighbour(df, ["k"], by_day(), {"n_id": F.col("id"), "n_v": F.col("v")}, direction, hot_rows)
    assert rows(got) == rows(want)


@pytest.mark.usefixtures("many_ranges")
@pytest.mark.parametrize("hot_rows", [200, 10_000_000])
@pytest.mark.parametrize("kind", ["bigint", "decimal(20,4)"])
def test_running_total_agrees_with_the_plain_window(spark, hot_rows, kind):
    df = skewed(spark).withColumn("v", F.col("v").cast(kind))
    w = Window.partitionBy("k").orderBy(*by_day()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("total", F.sum("v").over(w))
    assert rows(running_total(df, ["k"], by_day(), F.col("v"), "total", hot_rows)) == rows(want)


@pytest.mark.usefixtures("many_ranges")
def test_hot_rows_cross_range_borders(spark):
    seq = range_sequence(skewed(spark).where("k = 1"), [F.col("k"), *by_day()])
    assert seq.select(F.shiftright("_seq", 33)).distinct().count() > 1


def test_floating_running_total_is_refused(spark):
    df = spark.createDataFrame([(1, 0.5)], "k long, v double")
    with pytest.raises(TypeError):
        running_total(df, ["k"], [F.col("k")], F.col("v"), "s")


def test_merge_fails_on_a_double_match(spark):
    spec = changes.ChangeSpec("id", "v", ("v",), "I", "U", "D")
    target = spark.createDataFrame([(1, 1), (2, 2)], "id long, v long")
    double = spark.createDataFrame([(1, 5), (1, 6)], "id long, v long")
    for out in (
        changes.merge_upsert(target, double, spec),
        changes.change_log(target, double, spec),
        changes.snapshot_log(target, double, spec),
        changes.update_where_matched(target, double, spec, F.current_timestamp()),
    ):
        with pytest.raises(Exception, match="several source rows"):
            out.collect()
    nulls = spark.createDataFrame([(None, 5), (None, 6), (2, 9)], "id long, v long")
    assert rows(changes.merge_upsert(target, nulls, spec)) == sorted([(1, 1), (2, 9), (None, 5), (None, 6)], key=repr)


def test_continued_keys_take_null_as_a_value(spark):
    target = spark.createDataFrame([(1, "a"), (2, None)], "sk long, name string")
    batch = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", 4)], "name string, x long")
    got = continue_keys(batch, target, ["name"], "sk", business_key=["name"])
    assert rows(got) == [(3, "b", 3)]


def test_long_ranges_come_in_chunks(spark):
    one = spark.range(1)
    top = 9_223_372_036_854_775_807
    got = loops.explode_range(one, F.lit(top - 250_000), F.lit(top), 1, "i")
    assert got.agg(F.count("*"), F.min("i"), F.max("i")).first()[0:3] == (250_001, top - 250_000, top)
    down = loops.explode_range(one, F.lit(1_000_000), F.lit(3), -7, "i").agg(F.count("*"), F.min("i"), F.max("i")).first()
    want = range(1_000_000, 2, -7)
    assert down[0:3] == (len(want), min(want), max(want))


def test_ranges_of_any_length_and_step(spark):
    one, top = spark.range(1), 9_223_372_036_854_775_807
    series = lambda a, b, s: loops.explode_range(one, F.lit(a), F.lit(b), s, "i")
    assert [r.i for r in series(-top, top, 10**18).collect()] == list(range(-top, top + 1, 10**18))
    assert [r.i for r in series(0, 10**15, 10**14).collect()] == list(range(0, 10**15 + 1, 10**14))
    endless = series(0, 10**15, 1)
    assert [0 <= r.i <= 10**15 for r in endless.limit(5).collect()] == [True] * 5  # made as asked for
    several = spark.createDataFrame([(1, 0, 300_000, 3), (2, 5, 9, 1), (3, 9, 5, 1), (4, 70_000, -70_000, -2), (5, None, 3, 1)], "k long, a long, b long, s long")
    got = loops.explode_range(several, F.col("a"), F.col("b"), F.col("s"), "i").groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.sum("i"))
    want = {k: range(a, b + (1 if s > 0 else -1), s) for k, a, b, s in ((1, 0, 300_000, 3), (2, 5, 9, 1), (4, 70_000, -70_000, -2))}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {k: (len(w), min(w), max(w), sum(w)) for k, w in want.items()}


def test_short_ranges_are_not_shuffled(spark):
    plan = loops.explode_range(spark.range(10), F.lit(1), F.col("id"), 1, "i")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_running_total_counts_to_fifteen(spark):
    df = spark.range(1, 6).withColumn("k", F.lit("a"))
    got = running_total(df, ["k"], [F.col("id")], F.col("id"), "s")
    assert [r.s for r in got.orderBy("id").collect()] == [1, 3, 6, 10, 15]


def test_hot_key_is_spread_over_tasks(spark):
    df = skewed(spark).where("k = 1")
    seq = range_sequence(df, [F.col("k"), *by_day()], 8)
    sizes = [r["count"] for r in seq.groupBy(F.shiftright("_seq", 33).alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * df.count() / 8


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = skewed(spark)
    want = df.select(F.row_number().over(Window.orderBy(*by_day())).cast("long").alias("sk"), *df.columns)
    got = surrogate_key(df, ["day", "id"], "sk", num_partitions=7)
    assert got.columns[0] == "sk"
    assert rows(got) == rows(want)
    shifted = surrogate_key(df, ["day", "id"], "sk", start=101)
    assert (shifted.agg(F.min("sk")).first()[0], shifted.agg(F.max("sk")).first()[0]) == (101, 3100)
    assert surrogate_key(df.where("false"), ["id"], "sk").count() == 0


def test_surrogate_key_plan_has_no_single_task_over_rows(spark):
    got = surrogate_key(skewed(spark), ["day", "id"], "sk")
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The one-task window is over the per-partition counts; the rows only meet a broadcast join.
    assert "BroadcastHashJoin" in plan and plan.count("SinglePartition") <= 1
    assert "Python" not in plan.replace("PythonRDD", "")


def test_keys_continue_after_the_highest(spark):
    target = spark.createDataFrame([(5, "a"), (2, "b")], "sk long, name string")
    batch = spark.createDataFrame([("c",), ("a",), ("d",)], "name string")
    assert highest_key(target, "sk") == 5
    assert highest_key(target.where("false"), "sk") == 0
    assert rows(continue_keys(batch, target, ["name"], "sk")) == [(6, "a"), (7, "c"), (8, "d")]
    once = continue_keys(batch, target, ["name"], "sk", business_key=["name"])
    assert rows(once) == [(6, "c"), (7, "d")]
    assert continue_keys(batch, target.unionByName(once), ["name"], "sk", ["name"]).count() == 0


def test_keep_latest(spark):
    data = [(1, D(2020, 1, 1), "a"), (1, D(2020, 1, 2), "c"), (1, D(2020, 1, 2), "b"), (2, None, "x"), (None, D(2020, 1, 1), "n")]
    df = spark.createDataFrame(data, "k long, day date, v string")
    assert rows(keep_latest(df, ["k"], ["day"])) == [(1, D(2020, 1, 2), "b"), (2, None, "x")]
    assert keep_latest(df, ["k"], ["day"], drop_null_keys=False).count() == 3
    assert rows(keep_any(df, ["k"])) == [(1, D(2020, 1, 1), "a"), (2, None, "x")]


def test_dedupe_reduces_before_the_shuffle(spark):
    plan = keep_latest(skewed(spark), ["k"], ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_validity_ranges(spark):
    data = [
        (212, "AC-HE-HL-U509-R", "2011-07-01", "2007-12-28"),
        (213, "AC-HE-HL-U509-R", "2012-07-01", "2008-12-27"),
        (214, "AC-HE-HL-U509-R", "2013-07-01", None),
        (210, "CO-RF-FR-R92B-58", "2003-07-01", None),
    ]
    df = spark.createDataFrame(data, "id long, k string, s string, e string")
    df = df.select("id", "k", F.col("s").cast("timestamp").alias("s"), F.col("e").cast("date").alias("e"))
    got = validity_end(df, ["k"], "s", "e", ["id"])
    ends = {r.id: r.e for r in got.collect()}
    assert ends == {212: D(2012, 6, 30), 213: D(2013, 6, 30), 214: None, 210: None}
    assert {r.id for r in current_rows(got, "e").collect()} == {214, 210}


def test_validity_ranges_do_not_overlap(spark):
    df = skewed(spark).where("day IS NOT NULL AND k IS NOT NULL").dropDuplicates(["k", "day"])
    got = validity_end(df, ["k"], "day", "until", ["id"], hot_rows=30)
    assert got.where("until < day").count() == 0
    assert current_rows(got, "until").groupBy("k").count().where("count > 1").count() == 0
    assert current_rows(got, "until").count() == df.select("k").distinct().count()


def test_lookup_keeps_misses_and_multiplies_on_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, code string")
    dim = spark.createDataFrame([("a", 10), ("a", 11), (None, 99)], "code string, sk long")
    got = joins.lookup(left, dim, {"code": "code"}, {"sk": "sk"})
    assert rows(got) == sorted([(1, "a", 10), (1, "a", 11), (2, "b", None), (3, None, None)], key=repr)
    with pytest.raises(ValueError, match="not unique"):
        joins.lookup(left, dim, {"code": "code"}, {"sk": "sk"}, unique=True)


def test_orphans_and_existence(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk long")
    assert rows(joins.orphan_counts(child, parent, "fk", "pk")) == [(9, 2)]
    assert rows(joins.having_match(parent, child, {"pk": "fk"})) == [(1,), (1,)]


def test_lookup_with_defaults(spark):
    asked = spark.createDataFrame([(1, Decimal("3.5")), (7, Decimal("3.5"))], "id long, gpa decimal(10,1)")
    known = spark.createDataFrame([(1, "Alice Vance")], "id long, name string")
    got = joins.lookup_with_defaults(asked, known, {"id": "id"}, {"name": "name"}, {"name": "Unknown Student"})
    bonus = F.when(F.col("_found"), F.col("gpa") + Decimal("0.2")).otherwise(F.col("gpa"))
    out = got.select("id", "name", F.when(F.col("_found"), "Active").otherwise("Inactive"), bonus)
    assert rows(out) == [(1, "Alice Vance", "Active", Decimal("3.7")), (7, "Unknown Student", "Inactive", Decimal("3.5"))]


def test_accept_and_reject_cover_the_input(spark):
    df = skewed(spark)
    rules = [
        validation.Rule("no_key", F.col("k").isNull(), F.lit("no key")),
        validation.Rule("negative", F.col("v") < 0, F.concat(F.lit("bad "), F.col("v"))),
    ]
    flagged = validation.with_reason(df, rules)
    ok, bad = validation.accepted(flagged), validation.rejected(flagged)
    assert rows(ok.unionByName(bad.drop("reject_reason"))) == rows(df)
    # A NULL value breaks no rule.
    assert ok.where("k IS NULL OR v < 0").count() == 0 and ok.where("v IS NULL").count() > 0
    counts = dict(rows(validation.reject_counts(df, rules)))
    assert counts == {"no_key": df.where("k IS NULL").count(), "negative": df.where("k IS NOT NULL AND v < 0").count()}


def test_not_null_guard_fails_inside_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    with pytest.raises(Exception, match="NULL in required column name"):
        validation.guard_not_null(df, ["name"]).write.parquet(str(tmp_path / "t"))
    assert rows(validation.guard_not_null(df, ["id"])) == rows(df)
    assert rows(validation.null_counts(df, ["id", "name"])) == [("id", 0), ("name", 1)]


def test_non_empty_checks(spark):
    tables = {"silver.a": spark.range(6), "silver.b": spark.range(0)}
    lines = {r.message for r in validation.non_empty_checks(validation.row_counts(tables)).collect()}
    assert lines == {"Check Passed: silver.a contains 6 records.", "Check Failed: silver.b has 0 rows!"}


def test_column_counts_take_one_column_at_a_time(spark):
    values = [(1, "a", 0.0), (1, None, -0.0), (2, "a", float("nan")), (None, "b", float("nan")), (None, None, None)]
    df = spark.createDataFrame(values, "id long, name string, x double")
    counted = lambda t: [tuple(part.first()) for part in validation.column_counts(t, ["id", "name", "x"])]
    assert counted(df) == [("id", 3, 2), ("name", 3, 2), ("x", 4, 2)]
    assert counted(df.limit(0)) == [("id", 0, 0), ("name", 0, 0), ("x", 0, 0)]


def test_loops(spark):
    ten = spark.range(1, 11).withColumn("k", F.lit(1))
    done = loops.skip_and_stop(ten, ["k"], "id", F.col("id") == 5, F.col("id") == 8)
    assert sorted(r.id for r in done.collect()) == [1, 2, 3, 4, 6, 7]
    one = spark.range(1)
    series = lambda a, b, s: [r.i for r in loops.explode_range(one, F.lit(a), F.lit(b), s, "i").collect()]
    assert series(1, 5, 1) == [1, 2, 3, 4, 5] and series(5, 1, -1) == [5, 4, 3, 2, 1]
    assert series(1, 10, 2) == [1, 3, 5, 7, 9] and series(3, 1, 1) == []
    students = spark.createDataFrame([(101, "Alice", 95.5), (102, "Bob", 88.0), (103, "Charlie", 72.0)], "s_id long, s_name string, s_grade double")
    assert rows(loops.high_performers(students, 85.0)) == [(101, "Alice", 95.5), (102, "Bob", 88.0)]
    assert rows(loops.format_rows(students.limit(1), "%s: %s", "s_id", "s_name").select("line")) == [("101: Alice",)]


STUDENT = "student_id long, student_name string, score decimal(38,9), updated_at timestamp"

def run_ts():
    return F.lit("2026-01-02 03:04:05").cast("timestamp")


def students(spark, *data):
    return spark.createDataFrame([(i, n, None if s is None else Decimal(s), None) for i, n, s in data], STUDENT)


def test_feed_of_upserts_and_deletes(spark):
    calls = [(1, "Alice Smith", "85", "upsert", 1), (2, "Bob Jones", "72.5", "upsert", 2), (1, "Alice Smith", "90", "upsert", 3), (2, None, None, "delete", 4)]
    feed = spark.createDataFrame(
        [(k, n, None if s is None else Decimal(s), op, q) for k, n, s, op, q in calls],
        "student_id long, student_name string, score decimal(38,9), op string, seq long",
    )
    empty = students(spark)
    log = changes.feed_log(empty, feed, changes.STUDENTS).orderBy("seq").drop("seq")
    assert [tuple(r) for r in log.collect()] == [
        (1, "INSERT_STUDENT", None, Decimal(85)),
        (2, "INSERT_STUDENT", None, Decimal("72.5")),
        (1, "UPDATE_SCORE", Decimal(85), Decimal(90)),
        (2, "DELETE_STUDENT", Decimal("72.5"), None),
    ]
    after = changes.apply_feed(empty, feed, changes.STUDENTS, run_ts())
    assert [(r.student_id, r.student_name, r.score) for r in after.collect()] == [(1, "Alice Smith", Decimal(90))]


def test_upsert_edge_cases(spark):
    target = students(spark, (1, "Alice", "85"), (2, "Bob", "70"), (3, "Cy", "60"))
    source = students(spark, (1, "Renamed", "85"), (2, "Bob", None), (4, "New", "50"), (None, "No key", "1"), (None, "No key", "2")).drop("updated_at")
    merged = changes.merge_upsert(target, source, changes.STUDENTS, run_ts())
    got = {r.student_id: (r.student_name, r.score, r.updated_at is not None) for r in merged.where("student_id IS NOT NULL").collect()}
    # An unchanged score is stamped, a name is never updated, an update to NULL is kept.
    assert got == {
        1: ("Alice", Decimal(85), True),
        2: ("Bob", None, True),
        3: ("Cy", Decimal(60), False),
        4: ("New", Decimal(50), True),
    }
    assert merged.where("student_id IS NULL").count() == 2
    log = changes.change_log(target, source.where("student_id IS NOT NULL"), changes.STUDENTS)
    assert rows(log) == [(2, "UPDATE_SCORE", Decimal(70), None), (4, "INSERT_STUDENT", None, Decimal(50))]


def test_upsert_twice_equals_once(spark):
    target = students(spark, *[(i, f"n{i}", str(i)) for i in range(50)])
    source = students(spark, *[(i, f"m{i}", str(i * 2)) for i in range(25, 80)]).drop("updated_at")
    once = changes.merge_upsert(target, source, changes.STUDENTS, run_ts())
    assert rows(changes.merge_upsert(once, source, changes.STUDENTS, run_ts())) == rows(once)
    assert changes.change_log(once, source, changes.STUDENTS).isEmpty()


def test_delete_logs_absent_keys_too(spark):
    target = students(spark, (1, "Alice", "85"), (2, "Bob", "70"))
    gone = spark.createDataFrame([(2,), (9,), (9,)], "student_id long")
    assert [r.student_id for r in changes.delete_keys(target, gone, "student_id").collect()] == [1]
    assert rows(changes.delete_log(target, gone, changes.STUDENTS)) == sorted(
        [(2, "DELETE_STUDENT", Decimal(70), None), (9, "DELETE_STUDENT", None, None)], key=repr
    )


@pytest.mark.parametrize("hot_rows", [50, 10_000_000])
def test_feed_agrees_with_one_call_at_a_time(spark, hot_rows):
    rng = random.Random(3)
    start = {i: (f"old{i}", i % 7) for i in range(0, 60, 2)}
    calls = [
        (1 if rng.random() < 0.4 else rng.randint(0, 60), f"c{q}", rng.randint(0, 2), rng.choice(["upsert", "upsert", "delete"]), q)
        for q in range(600)
    ]
    table, log = dict(start), []
    for k, name, score, op, q in calls:
        old = table.get(k)
        if op == "delete":
            table.pop(k, None)
            log.append((q, k, "DELETE_STUDENT", None if old is None else old[1], None))
        elif old is None:
            table[k] = (name, score)
            log.append((q, k, "INSERT_STUDENT", None, score))
        else:
            table[k] = (old[0], score)
            if old[1] != score:
                log.append((q, k, "UPDATE_SCORE", old[1], score))
    target = spark.createDataFrame([(k, n, s, None) for k, (n, s) in start.items()], "student_id long, student_name string, score long, updated_at timestamp")
    feed = spark.createDataFrame(calls, "student_id long, student_name string, score long, op string, seq long").repartition(5)
    assert rows(changes.feed_log(target, feed, changes.STUDENTS, hot_rows)) == sorted(log, key=repr)
    after = changes.apply_feed(target, feed, changes.STUDENTS, run_ts())
    assert rows(after.drop("updated_at")) == sorted(((k, n, s) for k, (n, s) in table.items()), key=repr)


def test_snapshot_log_turns_old_into_new(spark):
    old = students(spark, *[(i, "n", str(i)) for i in range(40)])
    new = students(spark, *[(i, "n", str(i if i % 3 else i + 1)) for i in range(10, 60)])
    log = changes.snapshot_log(old, new, changes.STUDENTS)
    state = {r.student_id: r.score for r in old.collect()}
    for r in log.collect():
        assert state.get(r.student_id) == r.old_score
        if r.action_performed == "DELETE_STUDENT":
            del state[r.student_id]
        else:
            state[r.student_id] = r.new_score
    assert state == {r.student_id: r.score for r in new.collect()}


def test_conditional_update_ignores_unknown_keys(spark):
    target = students(spark, (1, "Alice", "85"), (2, "Bob", "70"))
    updates = students(spark, (2, "x", None), (9, "y", "1"))
    got = changes.update_where_matched(target, updates, changes.STUDENTS, run_ts())
    assert {(r.student_id, r.student_name, r.score, r.updated_at is not None) for r in got.collect()} == {
        (1, "Alice", Decimal(85), False),
        (2, "Bob", None, True),
    }


def test_scratch_can_be_dropped(spark):
    df = written(spark.range(3), "x")
    path = df.inputFiles()[0]
    assert drop_scratch(spark)
    assert not os.path.exists(path.removeprefix("file://"))
    assert written(spark.range(3), "x").count() == 3


@pytest.mark.parametrize("hot", ["5", "NULL"])
def test_lookup_splits_a_hot_key(spark, hot):
    """A third of the rows on one key (or on NULL), and a dimension that may not be broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = f"CASE WHEN id % 3 = 0 THEN {hot} ELSE id % 5000 END AS code"
        facts = spark.range(0, 200_000, 1, 16).selectExpr("id", key, "uuid() AS payload")
        dim = spark.range(5000).selectExpr("id AS code", "id * 10 AS sk")
        got = joins.lookup(facts, dim, {"code": "code"}, {"sk": "sk"})
        totals = got.agg(F.count("*"), F.count("sk"), F.sum("sk"))
        assert got.toArrow().num_rows == 200_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
        want = facts.agg(F.count("*"), F.count("code"), F.sum(F.col("code") * 10))
        assert tuple(totals.first()) == tuple(want.first())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
