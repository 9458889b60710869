"""The language of all documents, learned from four fifths of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.language import gram_counts, identified, learned_blocks
from moodstream.llm.registry import query, table
from moodstream.llm.shared import written

FOLDS = 5


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score. A document without an id teaches nothing and counts as held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(True))
    documents = table(spark, folder, "documents")
    counts = written(gram_counts(documents.filter(~held_out).select("text", "lang")), "gram-counts")
    return identified(documents.select("doc_id", held_out.alias("held_out"), "text"), learned_blocks(counts))
