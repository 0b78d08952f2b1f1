"""CSV landing files and streams: given tables are written as files, loaded and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierhouse.queries.changes import FEED, OLD, SPEC
from tierhouse.queries.registry import plain, query
from tierhouse.scratch import scratch_path
from tierhouse.sources.csv import read_csv, write_csv
from tierhouse.streaming.changes import ChangeTable, stream_changes
from tierhouse.streaming.files import ingest_new_files


@query("src_csv_load", "SELECT * FROM part")
def src_csv_load(src):
    path = scratch_path(src.spark, "csv")
    write_csv(src.part, path)
    return read_csv(src.spark, path, src.part.schema)


@query("src_csv_append", "SELECT * FROM orders")
def src_csv_append(src):
    landing, out = scratch_path(src.spark, "csv"), scratch_path(src.spark, "bronze")
    is_open = F.col("o_orderstatus") == "O"
    write_csv(src.orders.where(is_open), f"{landing}/first")
    write_csv(src.orders.where(~is_open), f"{landing}/second")
    schema = src.orders.schema
    read_csv(src.spark, f"{landing}/first/*.csv", schema).write.parquet(out)
    read_csv(src.spark, f"{landing}/sec*/*.csv", schema).write.mode("append").parquet(out)
    return src.spark.read.schema(schema).parquet(out)


@query("stream_file_ingest", "SELECT * FROM events")
def stream_file_ingest(src):
    landing, out, checkpoint = (scratch_path(src.spark, n) for n in ("landing", "bronze", "stream"))
    events, schema = src.events, src.events.schema
    for part in (F.col("event_type") == "view", F.col("event_type") != "view"):
        write_csv(events.where(part), landing, "append")
        ingest_new_files(src.spark, landing, schema, out, checkpoint)
    return src.spark.read.schema(schema).parquet(out)


@query(
    "stream_file_rejects",
    """SELECT 'good' AS kind, event_id, event_type, CAST(NULL AS VARCHAR) AS bad_line FROM events WHERE user_id % 10 <> 3
UNION ALL SELECT 'bad', NULL, NULL, 'E' || event_id || ',' || event_type FROM events WHERE user_id % 10 = 3""",
)
def stream_file_rejects(src):
    """Events as lines of which a tenth have no number: these are set aside, the others loaded."""
    landing, out, rejects, checkpoint = (scratch_path(src.spark, n) for n in ("landing", "bronze", "rejects", "stream"))
    events, bad = src.events, F.col("user_id") % 10 == 3
    for part in (F.col("event_type") == "view", F.col("event_type") != "view"):
        lines = events.where(part).select(F.when(bad, F.concat(F.lit("E"), "event_id")).otherwise(F.col("event_id").cast("string")).alias("event_id"), "event_type")
        write_csv(lines, landing, "append")
        schema = events.select("event_id", "event_type").schema
        ingest_new_files(src.spark, landing, schema, out, checkpoint, rejects=rejects, archive=f"{landing}-done")
    good = src.spark.read.parquet(out).select(F.lit("good").alias("kind"), "event_id", "event_type", F.lit(None).cast("string").alias("bad_line"))
    lines = src.spark.read.parquet(rejects)
    none = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ("event_id", "event_type")]
    return good.unionByName(lines.select(F.lit("bad").alias("kind"), *none, "bad_line"))


# The same order feed in two arrivals: low-priority orders come a day late.
_LATE = "segment = '5-LOW'"
_TWO_WAVES = f"""old_rows AS ({plain(OLD)}), feed AS (
  SELECT f.*, CASE WHEN {_LATE} THEN 1 ELSE 0 END AS wave FROM ({plain(FEED)}) f), chained AS (
  SELECT f.*, lag(op) OVER w AS prev_op, lag(cents) OVER w AS prev_cents, row_number() OVER w AS n,
    row_number() OVER (PARTITION BY id ORDER BY wave DESC, seq DESC) AS from_last
  FROM feed f WINDOW w AS (PARTITION BY id ORDER BY wave, seq)), stated AS (
  SELECT c.*, CASE WHEN n = 1 THEN o.id IS NOT NULL ELSE prev_op = 'upsert' END AS alive,
    CASE WHEN n = 1 THEN o.cents WHEN prev_op = 'upsert' THEN prev_cents END AS old_cents
  FROM chained c LEFT JOIN old_rows o ON o.id = c.id)"""


def _streamed(src) -> ChangeTable:
    landing, checkpoint, path = (scratch_path(src.spark, n) for n in ("feed", "stream", "changes"))
    base = src.sql(OLD).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    table = ChangeTable(path, base.schema, SPEC)
    table.create(base)
    feed = src.sql(FEED)
    for wave in (~F.expr(_LATE), F.expr(_LATE)):
        write_csv(feed.where(wave), landing, "append")
        stream_changes(src.spark, landing, feed.schema, table, checkpoint, "2026-01-02 03:04:05")
    return table


@query(
    "stream_change_log",
    f"""WITH {_TWO_WAVES}
SELECT seq, id, CASE WHEN op = 'delete' THEN 'DELETE_STUDENT' WHEN NOT alive THEN 'INSERT_STUDENT' ELSE 'UPDATE_SCORE' END
    AS action_performed, old_cents, CASE WHEN op = 'upsert' THEN cents END AS new_cents
FROM stated WHERE op = 'delete' OR NOT alive OR old_cents IS DISTINCT FROM cents""",
)
def stream_change_log(src):
    log = _streamed(src).log(src.spark)
    return log.select("seq", "id", "action_performed", "old_cents", "new_cents")


@query(
    "stream_change_state",
    f"""WITH {_TWO_WAVES}
SELECT id, segment, cents FROM chained WHERE from_last = 1 AND op = 'upsert'
UNION ALL SELECT id, segment, cents FROM old_rows WHERE id NOT IN (SELECT id FROM feed)""",
)
def stream_change_state(src):
    return _streamed(src).current(src.spark).select("id", "segment", "cents")
