"""SpotSigs fingerprints of all documents and of their edited texts."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.registry import query, table
from moodstream.llm.spotsigs import fingerprints_with_next

#: The likeness asked for is exact, so lengths rule out nothing.
LEAST = 0.0


@query("op10_spotsigs")
def op10_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return fingerprints_with_next(table(spark, folder, "documents"), least=LEAST)
