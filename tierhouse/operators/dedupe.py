"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Filtering row_number() = 1 makes Spark keep one row per key in every map
    # task before the shuffle, so even a hot key sends one row per task.
    window = Window.partitionBy(*keys).orderBy(*(order or map(F.col, keys)))
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    tie_break: Sequence[Column | str] | None = None,
    drop_null_keys: bool = True,
) -> DataFrame:
    """The row with the highest `latest_by` per key; NULL sorts as oldest.

    Ties fall to `tie_break`, by default all remaining columns, so the result
    is repeatable.
    """
    rows = _known(df, keys) if drop_null_keys else df
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in {*keys, *latest_by}]
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    order += [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in rest]
    return _first_by(rows, keys, order)


def keep_any(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[Column | str] | None = None, drop_null_keys: bool = True
) -> DataFrame:
    """One row per key, whichever; a fixed choice all the same (see keep_latest)."""
    return keep_latest(df, keys, [], tie_break, drop_null_keys)
