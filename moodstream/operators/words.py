"""Word counts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.text import token_rows, tokens
from moodstream.operators.ranking import top_per_group


def by_batch(messages: DataFrame, batch: str | Column = "batch_ts") -> DataFrame:
    """Messages dealt out so that a task holds few batches, before their words are counted by batch.

    A task then meets the words of a batch again and again and adds them up in a small table, whatever the length of the history: dealt out otherwise, every
    task has words of all batches, hardly any of them twice, and sends nearly all of them on. A batch with too many messages for one task is split among
    several; the counts by (batch, word) that follow are added up across tasks.
    """
    return messages.withColumn("_at", F.xxhash64(batch)).hint("rebalance", "_at").drop("_at")


def explode_words(
    messages: DataFrame, keep: Sequence[str] = (), words: Column | None = None
) -> DataFrame:
    """One row per word, with the columns to keep. Default: words of the raw text."""
    words = tokens(F.col("text")) if words is None else words
    return messages.select(*keep, token_rows(words).alias("word")).filter("word is not null")


def count_words(
    words: DataFrame, by: Sequence[str] = (), copies: str | None = None
) -> DataFrame:
    """Occurrences per word, within groups if given; `copies` weighs each row.

    Sums are combined in the map tasks, so a frequent word leaves each of them as one row.
    """
    total = F.count("*") if copies is None else F.sum(copies)
    return words.groupBy(*by, "word").agg(total.alias("cnt"))


def top_words(counts: DataFrame, k: int = 100, by: str = "batch_ts") -> DataFrame:
    """k most frequent words per group; ties go to the alphabetically first word."""
    return top_per_group(counts, by, [F.desc("cnt"), F.asc("word")], k)


def newest_batches(history: DataFrame, n: int, ts: str = "batch_ts") -> DataFrame:
    """All rows of the n newest batches of a history.

    The oldest of the n times is found first, from the time column alone, and then acts as a plain
    range filter on the history.
    """
    newest = history.select(ts).distinct().orderBy(F.desc(ts)).limit(n)
    return history.filter(F.col(ts) >= newest.agg(F.min(ts)).scalar())


def merge_counts(counts: DataFrame) -> DataFrame:
    """Word totals over all batches of a frame."""
    return counts.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def as_wide_rows(counts: DataFrame, by: str = "batch_ts", family: str = "word_count") -> DataFrame:
    """One row per batch with a map `family:word -> count as text`. For top lists, which are short."""
    cell = F.struct(
        F.concat(F.lit(f"{family}:"), F.col("word")), F.col("cnt").cast("string")
    )
    return counts.groupBy(by).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))


def from_wide_rows(wide: DataFrame, by: str = "batch_ts") -> DataFrame:
    """Back from wide rows to (batch, word, count)."""
    return wide.select(by, F.explode("cells").alias("qualifier", "value")).select(
        by,
        F.split_part("qualifier", F.lit(":"), F.lit(2)).alias("word"),
        F.col("value").cast("bigint").alias("cnt"),
    )
