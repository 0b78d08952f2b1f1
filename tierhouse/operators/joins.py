"""Lookups, referential checks and existence tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def lookup(
    rows: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str | Column],
    unique: bool = False,
) -> DataFrame:
    """`rows` plus the `take` columns (output name -> dim column) of the matching dim row.

    A left join on `on` (row column -> dim column); a miss gives NULLs and a
    repeated dim key multiplies rows unless `unique` asks for a check. No join
    hint: Spark broadcasts a dim whose size is known to be small, and otherwise
    sort-merges and splits skewed partitions of `rows`, NULL keys included.
    """
    if unique:
        require_unique(dim, list(on.values()))
    keys = {f"_dim_{i}": d for i, d in enumerate(on.values())}
    values = [(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in take.items()]
    side = dim.select(*[F.col(d).alias(k) for k, d in keys.items()], *values)
    match = F.lit(True)
    for row_column, key in zip(on, keys):
        match = match & (rows[row_column] == side[key])
    return rows.join(side, match, "left").drop(*keys)


def repeated_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def require_unique(dim: DataFrame, keys: Sequence[str]) -> None:
    """Fail if a key repeats, naming one."""
    example = repeated_keys(dim, keys).head(1)
    if example:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {example[0].asDict()}")


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows per child key that has no parent; a NULL key refers to nothing and is no orphan.

    Child rows are counted per key before the join, so a hot key is one row there.
    """
    counts = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return counts.join(known, F.col("orphan_key") == F.col("_parent"), "left_anti")


def having_match(rows: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with at least one match in `other` (EXISTS).

    `other` is reduced to its distinct keys map-side first, so its hot keys shrink.
    """
    names = {f"_other_{i}": o for i, o in enumerate(on.values())}
    keys = other.select(*[F.col(o).alias(n) for n, o in names.items()]).distinct()
    match = F.lit(True)
    for row_column, name in zip(on, names):
        match = match & (rows[row_column] == keys[name])
    return rows.join(keys, match, "left_semi")


def lookup_with_defaults(
    requests: DataFrame,
    directory: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str | Column],
    defaults: Mapping[str, object],
    matched: str = "_found",
) -> DataFrame:
    """lookup() with a default per column for misses, and a flag that tells a hit."""
    looked = lookup(requests, directory, on, {**take, matched: F.lit(True)})
    found = F.coalesce(F.col(matched), F.lit(False))
    filled = {n: F.when(F.col(matched), F.col(n)).otherwise(F.lit(defaults[n])) for n in take if n in defaults}
    return looked.withColumns({**filled, matched: found})
