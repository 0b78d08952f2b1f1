"""A change feed applied batch by batch, with its log.

The state is one Parquet table, partitioned by a hash bucket of the key. A batch
reads the buckets its keys fall into and writes them anew by Spark's dynamic
partition overwrite; all others stay as they are. The rows that a batch changes
are kept as they were before it until the next batch, so a batch that is
repeated after a failure gives the same state and the same log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierhouse.operators.changes import ChangeSpec, apply_feed, feed_log
from tierhouse.operators.skew import HOT_ROWS
from tierhouse.scratch import drop_path, listed, scratch_scope
from tierhouse.sources.warehouse import timestamp_lit
from tierhouse.streaming.files import landing_stream

BUCKET = "bucket"
BATCH = "batch"
BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(state_bytes: int) -> int:
    """Buckets that keep one near 256 MB."""
    return max(1, -(-state_bytes // BUCKET_BYTES))


@dataclass(frozen=True)
class ChangeTable:
    """A keyed table and its log as parquet folders below `path`; rows without a key are logged, not kept.

    `buckets` (see buckets_for) cannot change once the table exists: take more
    for a larger state (rebucket() writes the table anew elsewhere).
    """

    path: str
    schema: T.StructType
    spec: ChangeSpec
    hot_rows: int = HOT_ROWS
    buckets: int = 16

    @property
    def state_path(self) -> str:
        return f"{self.path}/state"

    @property
    def log_path(self) -> str:
        return f"{self.path}/log"

    @property
    def before_path(self) -> str:
        return f"{self.path}/before"

    def create(self, base: DataFrame) -> None:
        """Start from a snapshot (one row per key); what was there before goes."""
        self._write(base.where(F.col(self.spec.key).isNotNull()), "static")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.spec.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, replace: str = "dynamic") -> set[int]:
        """Replace the buckets of `rows`; returns which (at most `buckets` numbers)."""
        seen = Observation()
        # Rebalanced, so that a bucket is few files but a large one is still split.
        laid_out = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).observe(seen, F.collect_set(BUCKET).alias("buckets"))
        writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", replace)
        writer.partitionBy(BUCKET).parquet(self.state_path)
        return set(seen.get["buckets"])

    def _state(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.state_path)

    def touched(self, keys: DataFrame) -> tuple[list[int], DataFrame]:
        """The buckets of `keys` (at most `buckets` numbers), and their state rows; other partitions are not read."""
        numbers = sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())
        return numbers, self._state(keys.sparkSession).where(F.col(BUCKET).isin(numbers)).drop(BUCKET)

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as of the last batch."""
        return self._state(spark).drop(BUCKET)

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.log_path)

    def apply(self, feed: DataFrame, batch_id: int, run_ts: str) -> None:
        """Apply one batch. The last batch may be repeated; an earlier one is over and does nothing."""
        spark, key = feed.sparkSession, self.spec.key
        kept = {int(name.split("=")[1]): done for name, done in listed(spark, self.before_path) if name.startswith(f"{BATCH}=")}
        if any(number > batch_id and done for number, done in kept.items()):
            return
        with scratch_scope(spark):
            keys = feed.select(key).where(F.col(key).isNotNull()).distinct()
            numbers, rows = self.touched(keys)
            saved = f"{self.before_path}/{BATCH}={batch_id}"
            if not kept.get(batch_id):
                rows.join(keys, key, "left_semi").write.mode("overwrite").parquet(saved)
            before = spark.read.schema(self.schema).parquet(saved)
            log = feed_log(before, feed, self.spec, self.hot_rows).withColumn("changed_at", timestamp_lit(run_ts))
            log.write.mode("overwrite").parquet(f"{self.log_path}/{BATCH}={batch_id}")
            changed = apply_feed(before, feed.where(F.col(key).isNotNull()), self.spec, timestamp_lit(run_ts))
            written = self._write(rows.join(keys, key, "left_anti").unionByName(changed))
            for number in set(numbers) - written:  # all of its keys are gone
                drop_path(spark, f"{self.state_path}/{BUCKET}={number}")
        for number in kept:
            if number < batch_id:
                drop_path(spark, f"{self.before_path}/{BATCH}={number}")

    def rebucket(self, spark: SparkSession, target: ChangeTable) -> None:
        """Current rows as the base of another table folder."""
        target.create(self.current(spark))


def stream_changes(
    spark: SparkSession,
    landing: str,
    feed_schema: T.StructType,
    table: ChangeTable,
    checkpoint: str,
    run_ts: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Apply the change files that arrived since the last run, then stop.

    `files_per_batch` cuts a backlog into batches, each of which is kept while it is applied.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            table.apply(rows, batch_id, run_ts)
        finally:
            rows.unpersist()

    query = (
        landing_stream(spark, landing, feed_schema, files_per_batch)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
