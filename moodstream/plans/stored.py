"""The live views read from the serving tables that the stream job keeps.

No view opens a text of the input. The log names the parts that can hold the newest batches, so a view reads as many parts however long the history is.
"""

from pyspark.sql import DataFrame, SparkSession

from moodstream.operators.cloud import cloud
from moodstream.operators.filters import without_keyword
from moodstream.operators.recent import as_table
from moodstream.operators.sentiment import axis_bounds, class_shares, recent_history
from moodstream.operators.words import merge_counts
from moodstream.plans import sentiment, words
from moodstream.plans.registry import SQL, query
from moodstream.plans.serving import KEYWORD, SHOWN
from moodstream.plans.streams import restarted, utc
from moodstream.streaming.tables import read_latest, read_recent_text, read_sentiment, read_word_counts, read_words


def stored(view: str):
    """Register a view under `stored_<view>`, with the SQL of the query that makes it from the texts."""
    return query(SQL[view], f"stored_{view}")


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot."""
    return read_latest(spark, restarted(spark, folder))


def long_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the top lists of the newest batches."""
    return merge_counts(read_words(spark, restarted(spark, folder), newest=words.LONG))


def history(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The newest batches of the sentiment history."""
    stored_rows = read_sentiment(spark, restarted(spark, folder), newest=n)
    return recent_history(stored_rows.withColumn("batch_ts", utc("batch_ts")), n)


@stored("word_count_latest")
def word_count_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of the newest hour: one point read."""
    return latest(spark, folder).withColumn("batch_ts", utc("batch_ts"))


@stored("word_count_long")
def word_count_long(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the top lists of the newest hours."""
    return long_totals(spark, folder)


@stored("word_count_long_exact")
def word_count_long_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over all words of the newest hours."""
    return merge_counts(read_word_counts(spark, restarted(spark, folder), newest=words.LONG))


@stored("word_cloud_short")
def word_cloud_short(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of the newest hour with font sizes."""
    rows = without_keyword(latest(spark, folder), KEYWORD)
    return cloud(rows.select("word", "cnt")).select("word", "cnt", "font_size")


@stored("word_cloud_short_coloured")
def word_cloud_short_coloured(spark: SparkSession, folder: str) -> DataFrame:
    """The same with colours from scores drawn by word."""
    rows = without_keyword(latest(spark, folder), KEYWORD)
    return cloud(rows.select("word", "cnt"), scores="random", seed=7)


@stored("word_cloud_long")
def word_cloud_long(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent words of the newest hours, with font sizes and colours."""
    return cloud(without_keyword(long_totals(spark, folder), KEYWORD), scores="count", limit=100)


@stored("word_cloud_long_compat")
def word_cloud_long_compat(spark: SparkSession, folder: str) -> DataFrame:
    """The alphabetically last words."""
    return cloud(without_keyword(long_totals(spark, folder), KEYWORD), scores="count", limit=100, compat=True)


@stored("sentiment_history_short")
def sentiment_history_short(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 15 hours."""
    return history(spark, folder, sentiment.SHORT)


@stored("sentiment_history_long")
def sentiment_history_long(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 60 hours."""
    return history(spark, folder, sentiment.LONG)


@stored("history_bounds")
def history_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Axis limits of the short history."""
    return axis_bounds(history(spark, folder, sentiment.SHORT))


@stored("sentiment_pie")
def sentiment_pie(spark: SparkSession, folder: str) -> DataFrame:
    """Totals and shares over the long history."""
    return class_shares(history(spark, folder, sentiment.LONG))


@stored("recent_tweets")
def recent_tweets(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 5 messages: every batch has one at least, so they are in the newest 5 batches."""
    return as_table(read_recent_text(spark, restarted(spark, folder), SHOWN, newest=SHOWN), SHOWN)
