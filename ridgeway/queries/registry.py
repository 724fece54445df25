"""Names of queries, their callables and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name if no other is given, with its SQL twin."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in _QUERIES:
            raise ValueError(f"two queries are called {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
