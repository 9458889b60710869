"""Vocabulary and term-frequency features."""

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.text import VOCABULARY_TAIL, feature_tokens
from moodstream.operators.words import explode_words

# A vocabulary of up to this many terms is sent to every executor (a few MB); a longer one is joined
# in whatever way the optimizer finds best for its size.
MAX_BROADCAST_TERMS = 100_000


def build_vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """(term, idx): the most frequent words, then the placeholder terms.

    `counts` has (word, cnt). The top-n runs in the tasks; only its `size` rows are numbered.
    """
    common = (
        counts.filter(~F.col("word").isin(*VOCABULARY_TAIL))
        .orderBy(F.desc("cnt"), F.asc("word"))
        .limit(size)
        .select(F.col("word").alias("term"), "cnt")
    )
    # Counts below zero put the tail after every counted word, in its own order.
    tail = counts.sparkSession.createDataFrame(
        [(term, -i) for i, term in enumerate(VOCABULARY_TAIL, 1)], "term string, cnt bigint"
    )
    position = F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("term"))) - 1
    return common.unionByName(tail).select("term", position.cast("bigint").alias("idx"))


def join_vocabulary(
    words: DataFrame, vocabulary: DataFrame, how: str = "inner", max_terms: int | None = None
) -> DataFrame:
    """Words with their vocabulary row.

    `max_terms` is the proven size of the vocabulary, such as the n of the top-n that made it. If it
    is small enough the vocabulary is broadcast and the words stay where they are. `checked_size` finds
    it for a vocabulary of unknown size. Without it the optimizer decides by measured size.
    """
    if max_terms is not None and max_terms <= MAX_BROADCAST_TERMS:
        vocabulary = F.broadcast(vocabulary)
    return words.join(vocabulary.withColumnRenamed("term", "word"), "word", how)


def checked_size(vocabulary: DataFrame, at_most: int = MAX_BROADCAST_TERMS) -> int | None:
    """Number of terms if at most `at_most`, else None. Stops counting just beyond the limit."""
    size = vocabulary.limit(at_most + 1).count()
    return size if size <= at_most else None


def term_frequency(
    messages: DataFrame,
    vocabulary: DataFrame,
    key: Sequence[str] = ("id",),
    max_terms: int | None = None,
) -> DataFrame:
    """(key, idx, tf) for the terms of each message that are in the vocabulary.

    All words of a message are in one task, so the map side already sums them up.
    """
    words = explode_words(messages, key, feature_tokens(F.col("text")))
    return (
        join_vocabulary(words, vocabulary, max_terms=max_terms)
        .groupBy(*key, "idx")
        .agg(F.count("*").alias("tf"))
    )


def vectorizer(terms: Sequence[str], tokens: str = "tokens", features: str = "features"):
    """Sparse count vectors over a vocabulary in index order; row by row, no shuffle."""
    return CountVectorizerModel.from_vocabulary(list(terms), inputCol=tokens, outputCol=features)


def vocabulary_terms(vocabulary: DataFrame, at_most: int = MAX_BROADCAST_TERMS) -> list[str]:
    """Terms in index order on the driver, which a vectorizer needs. Refuses a longer vocabulary."""
    rows = vocabulary.orderBy("idx").limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than {at_most} terms")
    return [row["term"] for row in rows]


def labelled_points(
    labelled: DataFrame, terms: Sequence[str], label: str | Column = "sentiment"
) -> DataFrame:
    """All columns plus `label` and `features`, ready for a classifier."""
    label = F.col(label) if isinstance(label, str) else label
    frame = labelled.withColumns(
        {"label": label.cast("double"), "tokens": feature_tokens(F.col("text"))}
    )
    return vectorizer(terms).transform(frame).drop("tokens")
