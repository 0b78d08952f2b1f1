"""Accept / reject rules, not-null guards and row-count checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.functions.text import template

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """A row fails the rule when `failing` is true; `message` says why."""

    name: str
    failing: Column
    message: Column


def first_reason(rules: Sequence[Rule]) -> Column:
    """Message of the first rule that fails, in list order; NULL if none does."""
    out = None
    for rule in rules:
        hit = F.coalesce(rule.failing, F.lit(False))
        out = F.when(hit, rule.message) if out is None else out.when(hit, rule.message)
    return F.lit(None).cast("string") if out is None else out


def with_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, first_reason(rules))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON).isNotNull())


def reject_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rejected rows per rule name, counted map-side; rules without rejects do not appear."""
    name = None
    for rule in rules:
        hit = F.coalesce(rule.failing, F.lit(False))
        name = F.when(hit, rule.name) if name is None else name.when(hit, rule.name)
    return (
        flagged.select(name.alias("rule"))
        .where(F.col("rule").isNotNull())
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_rejected"))
    )


def guard_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` that fails while being written if one of `columns` is NULL; no extra pass."""
    guarded = {}
    for name in columns:
        error = F.raise_error(F.lit(f"NULL in required column {name}")).cast(df.schema[name].dataType)
        guarded[name] = F.when(F.col(name).isNull(), error).otherwise(F.col(name))
    return df.withColumns(guarded) if guarded else df


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its NULL count, from a single scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in columns])
    )
    return counted.select(pairs.alias("p")).select("p.column_name", "p.n_nulls")


def column_counts(df: DataFrame, columns: Sequence[str]) -> list[DataFrame]:
    """For each column one row (column_name, n_values, n_distinct), NULLs left out.

    A scan of its own for each column: several distinct counts in one aggregate
    would make every row into one for each column, keyed by all of them, and a
    task would hold the values of all columns at once.
    """
    counts = lambda c: df.agg(F.count(c).alias("n_values"), F.count_distinct(c).alias("n_distinct"))
    return [counts(c).select(F.lit(c).alias("column_name"), "*") for c in columns]


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for all tables in one job; no column is read."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def non_empty_checks(counts: DataFrame) -> DataFrame:
    """row_counts() plus a check line per table."""
    passed = template("Check Passed: %s contains %s records.", F.col("table_name"), F.col("n_rows"))
    failed = template("Check Failed: %s has 0 rows!", F.col("table_name"))
    return counts.withColumn("message", F.when(F.col("n_rows") == 0, failed).otherwise(passed))
