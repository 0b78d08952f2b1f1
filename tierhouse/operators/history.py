"""Validity ranges from change history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.operators.ordered import neighbour
from tierhouse.operators.skew import HOT_ROWS


def validity_end(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tie_break: Sequence[Column | str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`df` with `end` = the day before the key's next `start`; NULL on the open row.

    An `end` column already in `df` is replaced unread.
    """
    order = [F.col(start).asc_nulls_first()]
    order += [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in tie_break]
    following = F.col(start).cast("date")
    ranged = neighbour(df.drop(end), keys, order, {"_next_start": following}, "next", hot_rows)
    return ranged.withColumn(end, F.date_sub("_next_start", 1)).drop("_next_start")


def current_rows(df: DataFrame, end: str) -> DataFrame:
    """Open versions only."""
    return df.where(F.col(end).isNull())
