"""From raw documents to token digests in five stages, each written as Parquet and read again."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm.bpe_query import digests
from moodstream.llm.mixing import mixed_texts
from moodstream.llm.pii import with_surrogates
from moodstream.llm.pii_query import SECRET
from moodstream.llm.registry import table
from moodstream.llm.repetition import keep_good
from moodstream.llm.shared import written
from moodstream.llm.simhash import one_of_each


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    return one_of_each(docs, shingle=4, radius=4)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced."""
    return _measured(with_surrogates(docs, SECRET), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of the mix; a document taken more than once has a second row."""
    return _measured(mixed_texts(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the ids of every text, and of the bytes they decode to."""
    return digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("pii", surrogates),
    ("mixing", mixture),
    ("byte-level bpe", tokens),
]

#: SQL cannot express the surrogates. Tests run all stages, on edge rows too, and test each operator apart; no test recomputes the whole pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return written(STAGES[-1][1](spark, docs, sf_dir), "tokens")
