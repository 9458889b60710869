"""Compare queries with their check SQL: `python tests/oracle.py [scale] [query ...]`."""

import math
import os
import sys
import time
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session():
    """A local session for tests."""
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("moodstream-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str):
    """DuckDB with the test tables as views."""
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime | date):
        return value.isoformat()
    return repr(value)


def table_of(columns, rows):
    """Sorted column names and sorted rows of plain values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


# Spark type -> DuckDB type of the same values.
SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    """Whether a query and its SQL give the same columns, types and rows."""
    from moodstream.plans.catalogue import QUERIES, SQL

    start = time.time()
    frame = QUERIES[name](spark, folder)
    got = table_of(frame.columns, frame.collect())
    spent = time.time() - start
    if name not in SQL:
        return len(got[1]) > 0, f"rows only: {len(got[1])}, {spent:.1f}s"
    found = con.execute(SQL[name])
    wanted = table_of([c[0] for c in found.description], found.fetchall())
    types = {c[0]: str(c[1]) for c in found.description}
    note = f"{len(got[1])} rows, {spent:.1f}s"
    for column, kind in frame.dtypes:
        if SAME_TYPES.get(kind) != types.get(column):
            return False, f"type of {column}: {kind}, SQL {types.get(column)}"
    if got == wanted:
        return True, note
    if got[0] != wanted[0]:
        return False, f"columns {got[0]} != {wanted[0]}"
    missing = sorted(set(wanted[1]) - set(got[1]))[:2]
    extra = sorted(set(got[1]) - set(wanted[1]))[:2]
    return False, f"{note}, SQL {len(wanted[1])}; {types}; missing {missing}; extra {extra}"[:1500]


if __name__ == "__main__":
    from moodstream.plans.catalogue import QUERIES

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    data = f"/root/testdata/sf{scale}"
    spark, con = session(), database(data)
    failed = 0
    for key in sys.argv[2:] or QUERIES:
        try:
            ok, text = compare(spark, con, data, key)
        except Exception as error:  # noqa: BLE001
            ok, text = False, f"{type(error).__name__}: {str(error)[:1200]}"
        failed += not ok
        print("ok  " if ok else "FAIL", key, text, flush=True)
    sys.exit(failed > 0)
