"""Near duplicates of all documents by SimHash."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.registry import query, table
from moodstream.llm.shared import written
from moodstream.llm.simhash import components, fingerprints


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, fingerprint, component_id: 4-word shingles, links at 4 bits or fewer."""
    prints = written(fingerprints(table(spark, folder, "documents"), shingle=4), "simhash")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(prints, radius=4).select("doc_id", digits.alias("fingerprint"), "component_id")
