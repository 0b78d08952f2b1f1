"""Set-based forms of row loops."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.functions.text import template

# Values of a range that one row may hold as an array, and pieces that a long range is dealt out in.
CHUNK = 1 << 16
PIECES_PER_TASK = 4


def format_rows(df: DataFrame, fmt: str, *columns: str, name: str = "line") -> DataFrame:
    """`df` plus one formatted text line per row."""
    return df.withColumn(name, template(fmt, *[F.col(c) for c in columns]))


def _length(low: Column, high: Column, step: Column) -> Column:
    """How many values a range has, 0 if it is empty; exact for any bigint bounds."""
    wide = lambda c: c.cast("decimal(20,0)")
    near = F.call_function("div", F.try_subtract(high, low), step)
    steps = F.coalesce(near, F.call_function("div", wide(high) - wide(low), wide(step)))
    return F.when(F.when(step > 0, low <= high).otherwise(low >= high), steps + 1).otherwise(F.lit(0).cast("bigint"))


def _indexes(df: DataFrame, first: str, count: str, name: str) -> DataFrame:
    """One row for each index first .. first + count - 1, by digits: no array is longer than CHUNK.

    A digit's rows are made as they are asked for, so a range of any length
    streams. (Generated code would make all rows of an input row before it
    returns; the lambda keeps these generators out of it.)
    """
    columns = [c for c in df.columns if c not in (first, count)]
    low, left = F.col(first), F.col(count)
    for digit in (CHUNK**3, CHUNK**2, CHUNK, 1):
        numbers = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("__left") - 1, F.lit(digit)))
        df = df.withColumns({"__low": low, "__left": left}).withColumn("__at", F.explode(F.transform(numbers, lambda k: k * F.lit(digit))))
        low, left = F.col("__low") + F.col("__at"), F.least(F.lit(digit).cast("bigint"), F.col("__left") - F.col("__at"))
    return df.select(*columns, low.alias(name))


def explode_range(df: DataFrame, first: Column, last: Column, step: Column | int, name: str) -> DataFrame:
    """One row per integer first, first+step, ... up to last; none if the range is empty.

    A negative step counts down. `step` must not be 0. Ranges of up to CHUNK
    values are made in place, without a shuffle. Where there are longer ones,
    only those are cut into pieces, at offsets that follow from their length,
    and the pieces (a few for each task) are dealt out; a piece is counted up
    value by value, so neither the range nor a piece is ever held as a whole.
    """
    step = (F.lit(step) if isinstance(step, int) else step).cast("bigint")
    low, high = first.cast("bigint"), last.cast("bigint")
    ranges = df.select("*", low.alias("__first"), high.alias("__last"), step.alias("__step"), _length(low, high, step).alias("__n"))
    # Bounds may lie further apart than a bigint reaches, though no value does.
    far = F.try_subtract(F.col("__last"), F.col("__first")).isNull()
    long = (F.col("__n") > CHUNK) | ((F.col("__n") > 0) & far)
    in_place = F.when((F.col("__n") > 0) & ~long, F.sequence("__first", "__last", "__step"))
    out = ranges.select(*df.columns, F.explode(in_place).alias(name))
    if not ranges.agg(F.max(long)).first()[0]:
        return out
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.greatest(F.lit(CHUNK).cast("bigint"), F.call_function("div", F.col("__n") - 1, F.lit(tasks * PIECES_PER_TASK)) + 1)
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("__n") - 1, F.col("__size"))))
    cut = ranges.where(long).withColumn("__size", size).withColumn("__piece", pieces)
    start = F.col("__piece") * F.col("__size")
    dealt = cut.withColumns({"__from": start, "__count": F.least(F.col("__size"), F.col("__n") - start)}).repartition(tasks)
    at = _indexes(dealt.drop("__piece", "__size"), "__from", "__count", "__index")
    wide = (F.col("__first").cast("decimal(20,0)") + F.col("__index") * F.col("__step").cast("decimal(20,0)")).cast("bigint")
    value = F.when(far, wide).otherwise(F.col("__first") + F.col("__index") * F.col("__step"))
    return out.unionByName(at.select(*df.columns, value.alias(name)))


def skip_and_stop(df: DataFrame, keys: list[str], position: str, skip: Column, stop: Column) -> DataFrame:
    """Rows a loop over `position` processes: those before the key's first `stop` row, without `skip` rows.

    The skip test comes first, so a skipped row never stops the loop.
    """
    halts = (
        df.where(stop & ~F.coalesce(skip, F.lit(False)))
        .groupBy(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)])
        .agg(F.min(position).alias("_stop_at"))
    )
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    kept = df.where(~F.coalesce(skip, F.lit(False)))
    return (
        kept.join(halts, on, "left")
        .where(F.col("_stop_at").isNull() | (F.col(position) < F.col("_stop_at")))
        .select(*df.columns)
    )


def where_params(df: DataFrame, equals: Mapping[str, object] | None = None, at_least: Mapping[str, object] | None = None) -> DataFrame:
    """Rows matching named parameters; the values reach the scan as literals."""
    for name, value in (equals or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    for name, value in (at_least or {}).items():
        df = df.where(F.col(name) >= F.lit(value))
    return df


def high_performers(students: DataFrame, min_grade: float) -> DataFrame:
    """(s_id, s_name, s_grade) of students at or above a grade."""
    return where_params(students.select("s_id", "s_name", "s_grade"), at_least={"s_grade": min_grade})
