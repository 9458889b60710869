"""Word clouds and recent messages of the live view."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.operators.cloud import cloud
from moodstream.operators.filters import without_keyword
from moodstream.operators.recent import as_table, recent_per_batch
from moodstream.plans.messages import STREAM_SQL, arrivals, texts
from moodstream.plans.registry import query
from moodstream.plans.words import NEWEST_SQL, TOP_SQL, latest_top, long_totals

KEYWORD = "the"
SHOWN = 5  # messages shown, and kept per batch

SHORT_CLOUD_SQL = f"""{TOP_SQL},
words AS (
  SELECT word, cnt FROM top
  WHERE batch_ts = (SELECT max(batch_ts) FROM top) AND word <> '{KEYWORD}'
)"""

LONG_CLOUD_SQL = f"""{TOP_SQL},
words AS (
  SELECT word, CAST(sum(cnt) AS BIGINT) AS cnt FROM top
  WHERE {NEWEST_SQL} AND word <> '{KEYWORD}' GROUP BY word
)"""

SIZED_SQL = """sized AS (
  SELECT word, cnt, lo, spread,
         (round_even((cnt - lo) / spread * 2 - 1, 2) * 0.4::DOUBLE + 1) * 120 AS font_size
  FROM (SELECT word, cnt, min(cnt) OVER () AS lo, max(cnt) OVER () - min(cnt) OVER () + 1 AS spread
        FROM words)
)"""

BAND_SQL = """CASE WHEN step < -1 THEN '#EE6055' WHEN step < -0.5 THEN '#FDE74C'
                WHEN step < 0 THEN '#FFE6AC' WHEN step < 0.5 THEN '#D0F2DF'
                ELSE '#9CEC5B' END"""


def long_cloud_sql(width: str, order: str) -> str:
    """Long-term cloud with a given normalisation width and choice of words."""
    return f"""
    WITH {LONG_CLOUD_SQL}, {SIZED_SQL},
    scored AS (
      SELECT word, cnt, font_size, (cnt - lo) / {width} - 0.49::DOUBLE AS score,
             round_even(((cnt - lo) / {width} - 0.49::DOUBLE) * 2, 0) / 2 + 0.0::DOUBLE AS step
      FROM sized ORDER BY {order} LIMIT 100
    )
    SELECT word, cnt, font_size, score,
           {BAND_SQL} AS colour
    FROM scored
    """


@query(f"WITH {SHORT_CLOUD_SQL}, {SIZED_SQL} SELECT word, cnt, font_size FROM sized")
def word_cloud_short(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of the newest hour without the keyword, with font sizes."""
    words = without_keyword(latest_top(spark, folder), KEYWORD)
    return cloud(words.select("word", "cnt")).select("word", "cnt", "font_size")


@query(
    f"""
    WITH {SHORT_CLOUD_SQL}, {SIZED_SQL},
    drawn AS (
      SELECT word, cnt, font_size,
             CAST('0x' || substr(md5('7:' || word), 1, 8) AS BIGINT)::DOUBLE / 2147483648 - 1 AS score
      FROM sized
    ),
    scored AS (SELECT *, round_even(score * 2, 0) / 2 + 0.0::DOUBLE AS step FROM drawn)
    SELECT word, cnt, font_size, score, {BAND_SQL} AS colour FROM scored
    """
)
def word_cloud_short_coloured(spark: SparkSession, folder: str) -> DataFrame:
    """The same with colours from scores drawn by word."""
    words = without_keyword(latest_top(spark, folder), KEYWORD)
    return cloud(words.select("word", "cnt"), scores="random", seed=7)


@query(long_cloud_sql("spread", "cnt DESC, word"))
def word_cloud_long(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent words of the newest hours, with font sizes and colours by count."""
    words = without_keyword(long_totals(spark, folder), KEYWORD)
    return cloud(words, scores="count", limit=100)


@query(long_cloud_sql("nullif(spread - lo, 0)", "word DESC"))
def word_cloud_long_compat(spark: SparkSession, folder: str) -> DataFrame:
    """The alphabetically last words with the minimum taken off the spread twice."""
    words = without_keyword(long_totals(spark, folder), KEYWORD)
    return cloud(words, scores="count", limit=100, compat=True)


def newest_per_batch(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """k newest messages of every batch.

    The choice is made on keys; texts are joined to the chosen rows only.
    """
    candidates = (
        arrivals(spark, folder)
        .join(texts(spark, folder).select("doc_id"), "doc_id", "left_semi")
        .withColumnsRenamed({"event_id": "id", "ts": "event_ts"})
    )
    chosen = recent_per_batch(candidates, k)
    return chosen.join(texts(spark, folder), "doc_id")


def recent_per_window_sql(k: int) -> str:
    """k newest messages of every batch."""
    return f"""
    WITH {STREAM_SQL}
    SELECT batch_ts, event_id AS id, CAST(user_id AS VARCHAR) AS author, text FROM stream
    QUALIFY row_number() OVER (PARTITION BY batch_ts ORDER BY ts DESC, event_id DESC) <= {k}
    """


def per_window(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """Columns of the per-batch message list."""
    return newest_per_batch(spark, folder, k).select(
        "batch_ts", "id", F.col("user_id").cast("string").alias("author"), "text"
    )


@query(recent_per_window_sql(SHOWN))
def recent_per_window(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 5 messages of every hour."""
    return per_window(spark, folder, SHOWN)


@query(recent_per_window_sql(1))
def last_per_window(spark: SparkSession, folder: str) -> DataFrame:
    """The newest message of every hour."""
    return per_window(spark, folder, 1)


@query(
    f"""
    WITH {STREAM_SQL}
    SELECT substr(CAST(ts AS VARCHAR), 1, 19) AS "Time", text AS "Tweet",
           CAST(user_id AS VARCHAR) AS "Author"
    FROM stream ORDER BY ts DESC, event_id DESC LIMIT {SHOWN}
    """
)
def recent_tweets(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 5 messages of all, as the page shows them."""
    newest = (
        arrivals(spark, folder)
        .join(texts(spark, folder).select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.desc("ts"), F.desc("event_id"))
        .limit(SHOWN)
    )
    # At most 5 rows, so they go to the texts.
    found = texts(spark, folder).join(F.broadcast(newest), "doc_id")
    return as_table(
        found.select(
            F.col("event_id").alias("id"),
            F.col("ts").alias("event_ts"),
            F.col("ts").cast("string").alias("created_at"),
            F.col("user_id").cast("string").alias("author"),
            "text",
        ),
        SHOWN,
    )
