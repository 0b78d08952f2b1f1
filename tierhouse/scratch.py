"""Intermediate tables on the shared folder named by `spark.checkpoint.dir`.

A written table cuts the lineage like a checkpoint does, survives the loss of
any executor, and unlike a checkpoint can be read back column by column.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder; only a local[*] session that names none gets a temporary one."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="tierhouse-scratch-")
    spark.sparkContext.setCheckpointDir(f"file://{local}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Folders of the loads that are running, innermost last; see scratch_scope().
_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end.

    For loads, whose results are in tables by then: a DataFrame that was built
    inside must not be read afterwards. One load at a time in a session.
    """
    folder = f"{_application_folder(spark)}/load-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        drop_path(spark, folder)


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tierhouse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return f"{_scopes[-1] if _scopes else _application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, folder: str) -> bool:
    """Delete one intermediate table that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names of the folders inside one, and whether each was written to its end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    child = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = system.listStatus(path) if system.exists(path) else ()
    return [(f.getPath().getName(), system.exists(child(f.getPath(), "_SUCCESS"))) for f in found if f.isDirectory()]


def drop_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, once no DataFrame still reads them."""
    return drop_path(spark, _application_folder(spark))
