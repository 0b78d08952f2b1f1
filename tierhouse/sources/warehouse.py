"""Layers as databases and declared parquet tables in them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierhouse.functions import dates
from tierhouse.operators.validation import guard_not_null
from tierhouse.schemas import LOAD_DAY, LOAD_RUN, RUN_TS, UUID, Table

_TRACK = "spark.sql.hive.manageFilesourcePartitions"


def timestamp_lit(run_ts: dt.datetime | str) -> Column:
    """`run_ts` as a timestamp literal, read in the session zone."""
    text = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp")


def with_defaults(df: DataFrame, table: Table, run_ts: dt.datetime | str) -> DataFrame:
    """Declared default columns that `df` lacks; one run timestamp for all rows of a load.

    Identifiers are new on every evaluation, so add them only on the way to a table.
    """
    added = {name: F.trunc(F.col(source), "MM") for name, source in table.month_of.items() if name not in df.columns}
    for name, default in table.defaults.items():
        if name in df.columns:
            continue
        value = {RUN_TS: timestamp_lit(run_ts), UUID: F.uuid()}.get(default) if isinstance(default, str) else None
        added[name] = F.lit(default) if value is None else value
    return df.withColumns(added) if added else df


def conform(df: DataFrame, table: Table, run_ts: dt.datetime | str) -> DataFrame:
    """Defaults added, required columns guarded, columns in declared order and type."""
    full = guard_not_null(with_defaults(df, table, run_ts), table.not_null)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


class Warehouse:
    """Table access for one session; `prefix` keeps several warehouses apart.

    Each table's data is in a version folder of its own below `root` (the
    session's warehouse folder if not given), and in it each load has a folder
    of its own, which is a partition. A reload writes a new version, and only
    when that has succeeded does the table point to it: a reload that fails
    leaves the table as it was. The version before stays until the next reload,
    for readers that are still at it. A load that is repeated under its run id
    replaces its own folder and no other.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", root: str | None = None):
        self.spark = spark
        self.prefix = prefix
        self.root = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")

    def name(self, table: Table) -> str:
        return f"{self.prefix}{table.layer}.{table.name}"

    def create(self, *tables: Table, replace: bool = False) -> None:
        """Create if absent, or drop and create."""
        for table in tables:
            layer = f"{self.prefix}{table.layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
            if replace and self.spark.catalog.tableExists(self.name(table)):
                self.spark.sql(f"DROP TABLE {self.name(table)}")
                self._keep_versions(table)
            if not self.spark.catalog.tableExists(self.name(table)):
                self._declare(table)

    def _declare(self, table: Table) -> None:
        columns = f"{table.ddl}, {LOAD_RUN} string{f', {LOAD_DAY} date' if table.load_day else ''}"
        # Partitions are found in the folder, so that they switch together with it.
        kept = self.spark.conf.get(_TRACK)
        self.spark.conf.set(_TRACK, "false")
        try:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
                f"PARTITIONED BY ({', '.join((LOAD_RUN, *table.partitions))}) LOCATION '{self._version(table)}'"
            )
        finally:
            self.spark.conf.set(_TRACK, kept)

    def _versions(self, table: Table) -> str:
        return f"{self.root}/{self.name(table)}"

    def _version(self, table: Table) -> str:
        return f"{self._versions(table)}/{uuid.uuid4().hex}"

    def _location(self, table: Table) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name(table)}")
        return described.where("col_name = 'Location'").first().data_type

    def _folder(self, path: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _keep_versions(self, table: Table, *kept: str) -> None:
        """Delete all version folders but these: a handful, by their names."""
        path, system = self._folder(self._versions(table))
        names = {folder.rstrip("/").rsplit("/", 1)[1] for folder in kept}
        for found in system.listStatus(path) if system.exists(path) else ():
            if found.getPath().getName() not in names:
                system.delete(found.getPath(), True)

    def read(self, table: Table, besides: str | None = None) -> DataFrame:
        """The declared columns; `besides` leaves out what the load of that run id has written."""
        rows = self.spark.table(self.name(table))
        if besides is not None:
            rows = rows.where(F.col(LOAD_RUN) != _run_folder(besides))
        return rows.select(*table.columns)

    def read_day(self, table: Table, day: dt.date | str) -> DataFrame:
        """Rows stamped on one day; of a table with `load_day` only that day's partitions are read."""
        rows = self.spark.table(self.name(table))
        return rows.where((F.col(LOAD_DAY) == F.lit(day).cast("date")) & dates.on_day(table.load_day, day)).select(*table.columns)

    def overwrite(self, table: Table, df: DataFrame, run_ts: dt.datetime | str) -> int:
        """Full reload: a new version is written, then switched to; returns rows written.

        `df` may read the table itself. Readers of the version before can go on until the next reload.
        """
        self.create(table)
        old, new = self._location(table), self._version(table)
        try:
            rows = self._write(table, df, run_ts, f"{new}/{LOAD_RUN}={_run_folder('base')}")
        except Exception:
            path, system = self._folder(new)
            system.delete(path, True)
            raise
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{new}'")
        # The switch itself makes Spark forget the old files; refreshing would list the new ones once more.
        if self.spark.catalog.isCached(self.name(table)):
            self.spark.catalog.refreshTable(self.name(table))
        self._keep_versions(table, old, new)
        return rows

    def append(self, table: Table, df: DataFrame, run_ts: dt.datetime | str, run_id: str | None = None) -> int:
        """Add rows; a run id that is given again replaces what it has added before.

        `df` must not depend on those rows then: see `besides` of read().
        """
        rows = self._write(table, df, run_ts, f"{self._location(table)}/{LOAD_RUN}={_run_folder(run_id or uuid.uuid4().hex)}")
        self.spark.catalog.refreshTable(self.name(table))
        return rows

    def create_as(self, table: Table, df: DataFrame, run_ts: dt.datetime | str) -> int:
        """CREATE TABLE AS SELECT; an existing table keeps its rows until the new ones are written."""
        return self.overwrite(table, df, run_ts)

    def truncate(self, *tables: Table) -> None:
        for table in tables:
            self.overwrite(table, self.spark.createDataFrame([], table.schema), dt.datetime.now(dt.timezone.utc))

    def _write(self, table: Table, df: DataFrame, run_ts, folder: str) -> int:
        # The row count is observed by the write itself: no second scan.
        seen, rows = Observation(), conform(df, table, run_ts)
        if table.load_day:
            rows = rows.withColumn(LOAD_DAY, F.to_date(table.load_day))
        if table.partition_by:
            # Few files for each partition, but a large one is split over tasks.
            rows = rows.hint("rebalance", *table.partitions).sortWithinPartitions(*table.partitions, *table.cluster_by)
        out = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*table.partitions)
        out.parquet(folder, compression="zstd")  # tables are written once and kept
        return int(seen.get["rows"])


def _run_folder(run_id: str) -> str:
    return f"run-{run_id}"


def write_by_month(df: DataFrame, path: str, date_column: str, cluster_by: Sequence[str]) -> None:
    """Parquet by month of a date, clustered inside each file.

    The rebalance hint gathers a month's rows but lets adaptive execution split
    a month that is too large for one task.
    """
    month = F.trunc(F.col(date_column), "MM")
    laid_out = df.withColumn("order_month", month).hint("rebalance", "order_month")
    ordered = laid_out.sortWithinPartitions("order_month", *cluster_by)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order_month").parquet(path)
