"""Every operator as a query over the given tables, with the SQL it must agree with."""

from tierhouse.queries import changes, cleansing, files, jobs, layers, loads, modelling, shop  # noqa: F401
from tierhouse.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
