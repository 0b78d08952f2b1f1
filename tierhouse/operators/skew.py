"""Finding and separating keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.scratch import written

# A window group up to this size is left to one task (windows spill to disk).
HOT_ROWS = 10_000_000
# How often a key of that size is expected in the sample that looks for hot keys.
SAMPLED_HITS = 200


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on `keys`; Spark still plans it as an equi-join."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with about `hot_rows` rows or more, or None.

    Only the key columns are scanned. A key that large shows up some 200 times
    in the sample, so the shuffle is tiny; a borderline key may fall on either
    side, which changes the plan for its rows and never the result. At most
    2 * rows / hot_rows keys can qualify. They are written, so that every later
    use sees the same set and Spark knows its true size.
    """
    fraction = min(1.0, SAMPLED_HITS / hot_rows)
    seen = df.select(*keys)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    limit = hot_rows if fraction == 1.0 else SAMPLED_HITS // 2
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = written(counts.where(F.col("_rows") > limit).select(*keys), "hot-keys")
    return None if hot.isEmpty() else hot


def settled(df: DataFrame) -> DataFrame:
    """`df` itself if it is a plain scan (with filters and columns), else written once, so that looking at it twice is cheap."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return written(df, "settled") if any(node in plan for node in ("Join", "Aggregate", "Window", "Generate")) else df


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None); together they are `df`.

    No broadcast hint: the hot-key table is on disk, so Spark knows its size
    and broadcasts it only below its own threshold.
    """
    df = settled(df)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df, None
    on = same_keys(df, hot, keys)
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")
