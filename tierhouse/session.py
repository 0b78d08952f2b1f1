"""Session settings the package relies on."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Hard casts must raise (safe casts are spelled try_*), dates are UTC, and
# skewed join partitions are split at run time.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, minimum: int = 8) -> int:
    """Shuffle partitions that keep one partition near 256 MB.

    100 TB gives about 400,000; adaptive execution merges the ones that turn
    out small, so it is safe to size for the largest shuffle of a run.
    """
    return max(minimum, math.ceil(input_bytes / TARGET_PARTITION_BYTES))


def build_session(
    app_name: str = "tierhouse",
    master: str | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the required settings; `master` is left to spark-submit if None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes)))
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
