"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function (spark, sf_dir) -> DataFrame by its name, with its SQL if it has one."""

    def add(f: Callable[..., DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
