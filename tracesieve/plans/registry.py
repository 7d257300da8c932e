"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with the SQL that tells its result."""

    def register(f: Query) -> Query:
        name = f.__name__.removesuffix("_query")  # where a function of that name is imported
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register
