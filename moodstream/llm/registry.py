"""Registry of this package's queries and their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with check SQL if SQL can express it."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
