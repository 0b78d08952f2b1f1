"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.operators.dedupe import keep_any
from tierhouse.operators.ordered import dense_number
from tierhouse.operators.skew import same_keys


def _ordering(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def surrogate_key(
    df: DataFrame, order: Sequence[Column | str], name: str, start: int = 1, num_partitions: int | None = None
) -> DataFrame:
    """Keys start, start+1, ... along `order` as the first column."""
    return dense_number(df, _ordering(order), name, start, num_partitions)


def highest_key(target: DataFrame, name: str) -> int:
    """The largest key in use, 0 for an empty target: one number, from one column."""
    return target.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).first()[0]


def continue_keys(
    batch: DataFrame,
    target: DataFrame,
    order: Sequence[Column | str],
    name: str,
    business_key: Sequence[str] | None = None,
) -> DataFrame:
    """Rows to append to `target`, numbered on from its highest key.

    By default every batch row is appended, even one that is already there.
    With `business_key`, rows whose key (NULL being a value like any other) is
    in the target are left out and of several batch rows of one key one is
    taken, which makes a repeated run harmless.
    """
    rows = batch
    if business_key:
        present = target.select(*business_key).distinct()
        new = batch.join(present, same_keys(batch, present, business_key), "left_anti")
        rows = keep_any(new, business_key, drop_null_keys=False)
    return surrogate_key(rows, order, name, start=highest_key(target, name) + 1)
