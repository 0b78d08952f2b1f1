"""Upserts, deletes and change logs between two customer snapshots, and over an order feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierhouse.operators import changes
from tierhouse.queries.registry import plain, query
from tierhouse.sources.warehouse import timestamp_lit

RUN_TS = "2026-01-02 03:04:05"

SPEC = changes.ChangeSpec(
    key="id",
    watch="cents",
    update=("cents", "segment"),
    insert_action="INSERT_STUDENT",
    update_action="UPDATE_SCORE",
    delete_action="DELETE_STUDENT",
    stamp="updated_at",
)

# Two snapshots of all customers: building customers are new, machinery customers have left.
OLD = """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
  TIMESTAMP '2025-01-01 00:00:00' AS updated_at
FROM {customer} WHERE c_mktsegment <> 'BUILDING'"""
NEW = """
SELECT c_custkey AS id, upper(c_name) AS name, lower(c_mktsegment) AS segment,
  CASE WHEN c_nationkey % 7 = 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) + 100 WHEN c_nationkey % 7 = 1 THEN NULL
       ELSE CAST(round(c_acctbal * 100) AS BIGINT) END AS cents
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"""
_BOTH = f"WITH old_rows AS ({plain(OLD)}), new_rows AS ({plain(NEW)})"


def _old(src):
    return src.sql(OLD)


def _plain_time(df):
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query(
    "merge_upsert",
    f"""{_BOTH}
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN n.name ELSE o.name END AS name,
  CASE WHEN n.id IS NULL THEN o.segment ELSE n.segment END AS segment,
  CASE WHEN n.id IS NULL THEN o.cents ELSE n.cents END AS cents,
  CASE WHEN n.id IS NULL THEN o.updated_at ELSE TIMESTAMP '{RUN_TS}' END AS updated_at
FROM old_rows o FULL JOIN new_rows n ON o.id = n.id""",
)
def merge_upsert(src):
    return _plain_time(changes.merge_upsert(_old(src), src.sql(NEW), SPEC, timestamp_lit(RUN_TS)))


@query(
    "conditional_update",
    f"""{_BOTH}
SELECT o.id, o.name, CASE WHEN n.id IS NULL THEN o.segment ELSE n.segment END AS segment,
  CASE WHEN n.id IS NULL THEN o.cents ELSE n.cents END AS cents,
  CASE WHEN n.id IS NULL THEN o.updated_at ELSE TIMESTAMP '{RUN_TS}' END AS updated_at
FROM old_rows o LEFT JOIN new_rows n ON o.id = n.id""",
)
def conditional_update(src):
    return _plain_time(changes.update_where_matched(_old(src), src.sql(NEW), SPEC, timestamp_lit(RUN_TS)))


@query(
    "upsert_log",
    f"""{_BOTH}
SELECT n.id, CASE WHEN o.id IS NULL THEN 'INSERT_STUDENT' ELSE 'UPDATE_SCORE' END AS action_performed,
  o.cents AS old_cents, n.cents AS new_cents
FROM new_rows n LEFT JOIN old_rows o ON o.id = n.id WHERE o.id IS NULL OR o.cents IS DISTINCT FROM n.cents""",
)
def upsert_log(src):
    return changes.change_log(_old(src), src.sql(NEW), SPEC)


@query(
    "change_log",
    f"""{_BOTH}
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'INSERT_STUDENT' WHEN n.id IS NULL THEN 'DELETE_STUDENT'
  ELSE 'UPDATE_SCORE' END AS action_performed, o.cents AS old_cents, n.cents AS new_cents
FROM old_rows o FULL JOIN new_rows n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL OR o.cents IS DISTINCT FROM n.cents""",
)
def change_log(src):
    return changes.snapshot_log(_old(src), src.sql(NEW), SPEC)


# Asked to delete: every customer with a pending order, also those the snapshot does not hold.
LEAVERS = "SELECT DISTINCT o_custkey AS id FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"


@query(
    "delete_with_log",
    f"""WITH old_rows AS ({plain(OLD)}), gone AS ({plain(LEAVERS)})
SELECT id, 'KEPT' AS action_performed, cents AS old_cents, cents AS new_cents FROM old_rows
WHERE id NOT IN (SELECT id FROM gone)
UNION ALL
SELECT g.id, 'DELETE_STUDENT', o.cents, NULL FROM gone g LEFT JOIN old_rows o ON o.id = g.id""",
)
def delete_with_log(src):
    old, gone = _old(src), src.sql(LEAVERS)
    kept = changes.delete_keys(old, gone, "id").select(
        "id", F.lit("KEPT").alias("action_performed"), F.col("cents").alias("old_cents"), F.col("cents").alias("new_cents")
    )
    return kept.unionByName(changes.delete_log(old, gone, SPEC))


# Every order is one call for its customer, in order-key order; pending orders delete.
FEED = """
SELECT o_custkey AS id, 'name of ' || CAST(o_orderkey AS STRING) AS name, o_orderpriority AS segment,
  CAST(round(o_totalprice) AS BIGINT) % 3 AS cents, CASE o_orderstatus WHEN 'P' THEN 'delete' ELSE 'upsert' END AS op,
  o_orderkey AS seq
FROM {orders}"""

_FEED_STATES = f"""old_rows AS ({plain(OLD)}), feed AS ({plain(FEED)}), chained AS (
  SELECT f.*, lag(op) OVER w AS prev_op, lag(cents) OVER w AS prev_cents, row_number() OVER w AS n
  FROM feed f WINDOW w AS (PARTITION BY id ORDER BY seq)), stated AS (
  SELECT c.*, CASE WHEN n = 1 THEN o.id IS NOT NULL ELSE prev_op = 'upsert' END AS alive,
    CASE WHEN n = 1 THEN o.cents WHEN prev_op = 'upsert' THEN prev_cents END AS old_cents
  FROM chained c LEFT JOIN old_rows o ON o.id = c.id)"""


@query(
    "feed_log",
    f"""WITH {_FEED_STATES}
SELECT seq, id, CASE WHEN op = 'delete' THEN 'DELETE_STUDENT' WHEN NOT alive THEN 'INSERT_STUDENT' ELSE 'UPDATE_SCORE' END
    AS action_performed, old_cents, CASE WHEN op = 'upsert' THEN cents END AS new_cents
FROM stated WHERE op = 'delete' OR NOT alive OR old_cents IS DISTINCT FROM cents""",
)
def feed_log(src):
    return changes.feed_log(_old(src), src.sql(FEED), SPEC)


@query(
    "feed_apply",
    f"""WITH {_FEED_STATES}, births AS (
  SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM stated WHERE op = 'upsert' AND NOT alive),
last_call AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM stated)
SELECT l.id, coalesce(b.name, o.name) AS name, l.segment, l.cents, TIMESTAMP '{RUN_TS}' AS updated_at
FROM last_call l LEFT JOIN births b ON b.id = l.id AND b.r = 1 LEFT JOIN old_rows o ON o.id = l.id
WHERE l.r = 1 AND l.op = 'upsert'
UNION ALL SELECT id, name, segment, cents, updated_at FROM old_rows WHERE id NOT IN (SELECT id FROM feed)""",
)
def feed_apply(src):
    return _plain_time(changes.apply_feed(_old(src), src.sql(FEED), SPEC, timestamp_lit(RUN_TS)))
