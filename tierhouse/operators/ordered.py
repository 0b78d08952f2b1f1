"""Operators over a total order that never put a large group into one task.

Rows are range-partitioned and sorted once, numbered inside their partition
and written; what crosses a partition border is then carried by a table with
one row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierhouse.operators.skew import HOT_ROWS, split_hot
from tierhouse.scratch import written

SEQ = "_seq"
_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below
_ROW_MASK = (1 << _ROW_BITS) - 1


def _part() -> Column:
    return F.shiftright(F.col(SEQ), _ROW_BITS)


def _row() -> Column:
    return F.col(SEQ).bitwiseAND(F.lit(_ROW_MASK))


def range_sequence(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None = None) -> DataFrame:
    """`df` plus `_seq`, which increases along `order`, written to the shared folder.

    One range shuffle and one sort. Writing it fixes the numbering: sampled
    range borders may differ if the plan were run again.
    """
    order = list(order)
    parts = [num_partitions] if num_partitions else []
    ordered = df.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    return written(ordered.withColumn(SEQ, F.monotonically_increasing_id()), "ordered")


def dense_number(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str,
    start: int | Column = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Numbers start..start+N-1 along `order`, as the first column.

    The plain form, row_number() over the whole table, sorts everything in
    one task. Here each task numbers its own range and adds the row count of
    the ranges before it. `order` must be a total order for a repeatable result.
    """
    seq = range_sequence(df, order, num_partitions)
    sizes = seq.groupBy(_part().alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: this window and the broadcast are bounded by their number.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    number = (F.col("_before") + _row() + first).cast("bigint").alias(name)
    return seq.join(F.broadcast(offsets), _part() == F.col("_part")).select(number, *df.columns)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Mapping[str, Column],
    direction: str = "next",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`df` plus, per output name, the value of the next / previous row of the same key.

    Ordinary keys use one window shuffle. Keys above `hot_rows` are spread
    over range partitions, each of which looks at its border neighbour.
    """
    if direction not in ("next", "previous"):
        raise ValueError(f"unknown direction {direction!r}")
    ordinary, hot = split_hot(df, keys, hot_rows)
    step = F.lead if direction == "next" else F.lag
    window = Window.partitionBy(*keys).orderBy(*order)
    out = ordinary.select("*", *[step(v).over(window).alias(n) for n, v in values.items()])
    if hot is None:
        return out
    return out.unionByName(_hot_neighbour(hot, keys, order, values, direction))


def _hot_neighbour(df, keys, order, values, direction) -> DataFrame:
    ascending = direction == "next"
    payload = F.struct(*keys, *[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    seq = range_sequence(df, [F.col(k) for k in keys] + list(order)).select(
        "*", _part().alias("_part"), payload.alias("_self")
    )
    # A range partition, not a key, is the unit of work, so groups stay even.
    inside = Window.partitionBy("_part").orderBy(SEQ)
    looked = seq.withColumn("_near", (F.lead if ascending else F.lag)("_self").over(inside))
    edge = (F.min_by if ascending else F.max_by)("_self", SEQ)
    borders = seq.groupBy("_part").agg(edge.alias("_edge"))
    # One row per range partition: bounded, whatever the data size.
    across = Window.orderBy("_part")
    carried = borders.select("_part", (F.lead if ascending else F.lag)("_edge").over(across).alias("_carry"))
    near = F.coalesce(F.col("_near"), F.col("_carry"))
    same = F.lit(True)
    for k in keys:
        same = same & near[k].eqNullSafe(F.col(k))
    picked = [F.when(same, near[f"_v{i}"]).alias(n) for i, n in enumerate(values)]
    # One row per partition, but with keys and values: Spark broadcasts it only below its own threshold.
    return looked.join(carried, "_part").select(*df.columns, *picked)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`df` plus the sum of `value` from the first row of the key to this one.

    Only integers and decimals: a floating sum would depend on how rows are split.
    """
    if df.select(value.alias("v")).schema["v"].dataType.typeName() in ("float", "double"):
        raise TypeError("running_total() of a floating column would depend on the plan; cast it to a decimal")
    ordinary, hot = split_hot(df, keys, hot_rows)
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ordinary.withColumn(name, F.sum(value).over(window))
    if hot is None:
        return out
    return out.unionByName(_hot_running_total(hot, keys, order, value, name))


def _hot_running_total(df, keys, order, value, name) -> DataFrame:
    seq = range_sequence(df, [F.col(k) for k in keys] + list(order)).select(
        "*", _part().alias("_part"), value.alias("_value")
    )
    inside = (
        Window.partitionBy("_part", *keys).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = seq.withColumn("_sum", F.sum("_value").over(inside))
    parts = seq.groupBy("_part", *keys).agg(F.sum("_value").alias("_total"))
    # A key appears once per partition it touches: at most partitions + hot keys rows. They hold
    # keys and sums, so Spark broadcasts them only below its own threshold.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        F.col("_part").alias("_p"),
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.sum("_total").over(earlier).alias("_before"),
    )
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    total = F.when(F.col("_before").isNull(), F.col("_sum")).otherwise(
        F.col("_before") + F.coalesce(F.col("_sum"), F.lit(0))
    )
    plain = df.columns
    return summed.join(carried, on, "left").select(*plain, total.cast(summed.schema["_sum"].dataType).alias(name))
