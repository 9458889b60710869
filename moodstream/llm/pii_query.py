"""All documents with surrogates in place of personal data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.pii import with_surrogates
from moodstream.llm.registry import query, table

#: For tests and checks; a production run passes its own.
SECRET = b"surrogates"


@query("op3_pii_surrogates")
def op3_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, text with surrogates, number and kinds of replacements."""
    given = table(spark, folder, "documents").select("doc_id", "text")
    return with_surrogates(given, SECRET).select(
        "doc_id", "text", F.size("pii_kinds").cast("long").alias("n_replaced"), F.array_join("pii_kinds", " ").alias("kinds")
    )
