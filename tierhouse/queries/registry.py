"""Names of the queries, their Spark builds and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_BUILDS: dict[str, Build] = {}
_SQL: dict[str, str] = {}


class Source:
    """The given tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over the given tables, named as {orders} and so on."""
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same SQL with bare table names, for the other engine."""
    for table in TABLES:
        text = text.replace("{" + table + "}", table)
    return text


def query(name: str, sql: str | None = None) -> Callable:
    """Register a build `f(source) -> DataFrame` under `name`."""

    def register(build: Callable[[Source], DataFrame]) -> Callable:
        if name in _BUILDS:
            raise ValueError(f"query {name} is registered twice")
        _BUILDS[name] = lambda spark, folder: build(Source(spark, folder))
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def queries() -> dict[str, Build]:
    return dict(_BUILDS)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
