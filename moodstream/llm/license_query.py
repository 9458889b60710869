"""Licence notices of all documents."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.licenses import license_notices
from moodstream.llm.registry import query, table


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, length, license, saved, n_differences, differences: one row per notice."""
    return license_notices(table(spark, folder, "documents"))
