"""Registry of queries and their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with check SQL if SQL can express it."""

    def register(build: Query) -> Query:
        key = name or build.__name__
        QUERIES[key] = build
        if sql is not None:
            SQL[key] = sql
        return build

    return register
