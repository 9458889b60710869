"""Scoring and sentiment history."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.scores import polarity, polarity_colour
from moodstream.functions.text import feature_tokens
from moodstream.operators.model import LinearModel, mean_weight, score_by_join, score_messages
from moodstream.operators.ranking import numbered, trailing_sum
from moodstream.operators.sentiment import (
    axis_bounds,
    class_shares,
    count_predictions,
    recent_history,
    sentiment_history,
    with_volume,
)
from moodstream.plans.messages import (
    ENGLISH_SQL,
    STREAM_SQL,
    copies,
    english,
    newest_message_copies,
    placeholders_sql,
    spread,
    texts,
    tokens_sql,
)
from moodstream.plans.registry import query
from moodstream.streaming.folders import written

SHORT = 15  # batches in the short history
LONG = 60  # batches in the long history

# A small model for the checks. Multiples of 1/8 add up without rounding in any order.
LEXICON = {
    "good": 1.0,
    "great": 1.25,
    "best": 1.5,
    "better": 0.75,
    "love": 2.0,
    "happy": 1.5,
    "well": 0.5,
    "right": 0.5,
    "new": 0.25,
    "free": 0.75,
    "help": 0.5,
    "the": 0.125,
    "this": 0.25,
    "with": 0.5,
    "thing": 0.75,
    "bad": -1.0,
    "wrong": -1.25,
    "worst": -1.5,
    "hard": -0.5,
    "war": -1.75,
    "death": -1.5,
    "lost": -0.75,
    "not": -0.5,
    "no": -0.5,
    "never": -0.75,
    "of": -0.25,
    "from": -0.375,
    "than": -0.5,
    "pseudoplaceholder": -0.125,
    "hashtagplaceholder": 0.375,
    "linkplaceholder": -0.375,
}
MODEL = LinearModel(LEXICON)

LEXICON_SQL = "lexicon(word, weight) AS (VALUES {})".format(
    ", ".join(f"('{word}', CAST({weight} AS DOUBLE))" for word, weight in LEXICON.items())
)


def scored_sql(source: str, key: str = "id", known: str = "true") -> str:
    """CTE with margin and prediction per key, from the lexicon's words that fulfil `known`."""
    return f"""{LEXICON_SQL},
scored AS (
  SELECT {key}, coalesce(sum(weight), 0.0) AS margin,
         CASE WHEN coalesce(sum(weight), 0.0) > 0 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT {key}, unnest(CASE WHEN len(t) = 0 THEN [''] ELSE t END) AS word
        FROM (SELECT {key}, {tokens_sql(placeholders_sql('text'))} AS t FROM {source}))
  LEFT JOIN (SELECT * FROM lexicon WHERE {known}) USING (word)
  GROUP BY {key}
)"""


HISTORY_SQL = f"""{STREAM_SQL},
{scored_sql('stream', 'event_id')},
predicted AS (SELECT batch_ts, prediction FROM stream JOIN scored USING (event_id)),
history AS (
  SELECT batch_ts, count_if(prediction = 0) AS negative, count_if(prediction = 1) AS positive
  FROM predicted GROUP BY batch_ts
)"""


def recent_sql(n: int) -> str:
    """CTE with the n newest batches."""
    return f"""{HISTORY_SQL},
recent AS (
  SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive,
         CAST(negative + positive AS BIGINT) AS volume,
         row_number() OVER (ORDER BY batch_ts) AS position
  FROM (SELECT * FROM history ORDER BY batch_ts DESC LIMIT {n})
)"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_ts, prediction, copies) of the whole history.

    Scoring needs one pass over the texts and no shuffle; only (doc_id, prediction) is joined.
    """
    scored = score_messages(spread(texts(spark, folder), "doc_id"), MODEL).select("doc_id", "prediction")
    return copies(spark, folder).join(scored, "doc_id").drop("doc_id")


def newest_history(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """Sentiment history of the n newest batches; only texts that arrived in them are scored."""
    carried = spread(texts(spark, folder), "doc_id")
    arrived = newest_message_copies(spark, folder, n).join(carried, "doc_id")
    scored = score_messages(arrived, MODEL).select("batch_ts", "copies", "prediction")
    return recent_history(sentiment_history(scored, copies=F.col("copies")), n)


@query(f"WITH {ENGLISH_SQL}, {scored_sql('english')} SELECT id, margin, prediction FROM scored")
def linear_score(spark: SparkSession, folder: str) -> DataFrame:
    """Margin and prediction of every English message, within the row."""
    return score_messages(spread(english(spark, folder)), MODEL).select("id", "margin", "prediction")


@query(f"WITH {ENGLISH_SQL}, {scored_sql('english')} SELECT id, margin, prediction FROM scored")
def linear_score_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the weights as a table."""
    weights = spark.createDataFrame(list(LEXICON.items()), "term string, weight double")
    return score_by_join(spread(english(spark, folder)), weights, max_terms=len(LEXICON))


@query(
    f"""
    WITH {ENGLISH_SQL}, {scored_sql('english')}
    SELECT id, score,
           CASE WHEN score >= 0.1 THEN 'positive' WHEN score <= -0.1 THEN 'negative'
                ELSE 'neutral' END AS polarity,
           CASE WHEN score >= 0.1 THEN '#002C0D' WHEN score <= -0.1 THEN '#270000'
                ELSE '#0C0F0A' END AS colour
    FROM (SELECT id, margin / greatest(len({tokens_sql(placeholders_sql('text'))}), 1) AS score
          FROM scored JOIN english USING (id))
    """
)
def score_polarity(spark: SparkSession, folder: str) -> DataFrame:
    """Mean word weight of every English message as positive, neutral or negative."""
    score = mean_weight(feature_tokens(F.col("text")), MODEL)
    return spread(english(spark, folder)).select("id", score.alias("score")).select(
        "id",
        "score",
        polarity(F.col("score")).alias("polarity"),
        polarity_colour(F.col("score")).alias("colour"),
    )


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, prediction, count(*) AS cnt FROM predicted GROUP BY batch_ts, prediction
    """
)
def sentiment_by_window(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions per hour of arrival."""
    return count_predictions(predictions(spark, folder), copies="copies")


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive,
           CAST(negative + positive AS BIGINT) AS volume
    FROM history
    """
)
def sentiment_history_all(spark: SparkSession, folder: str) -> DataFrame:
    """The whole sentiment history, one row per hour."""
    history = sentiment_history(predictions(spark, folder), copies=F.col("copies"))
    return with_volume(history)


@query(f"WITH {recent_sql(SHORT)} SELECT * FROM recent")
def sentiment_history_short(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 15 hours with a message."""
    return newest_history(spark, folder, SHORT)


@query(f"WITH {recent_sql(LONG)} SELECT * FROM recent")
def sentiment_history_long(spark: SparkSession, folder: str) -> DataFrame:
    """The newest 60 hours with a message."""
    return newest_history(spark, folder, LONG)


@query(
    f"""
    WITH {recent_sql(SHORT)}
    SELECT min(position) AS min_position, max(position) AS max_position,
           min(volume) AS min_volume, max(volume) AS max_volume,
           least(min(negative), min(positive)) AS min_sentiment,
           greatest(max(negative), max(positive)) AS max_sentiment
    FROM recent
    """
)
def history_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Axis limits of the short history."""
    return axis_bounds(newest_history(spark, folder, SHORT))


@query(
    f"""
    WITH {recent_sql(LONG)},
    totals AS (SELECT CAST(sum(positive) AS BIGINT) AS p, CAST(sum(negative) AS BIGINT) AS n
               FROM recent)
    SELECT 'Positive' AS label, p AS cnt, p / (p + n) AS share FROM totals
    UNION ALL SELECT 'Negative', n, n / (p + n) FROM totals
    """
)
def sentiment_pie(spark: SparkSession, folder: str) -> DataFrame:
    """Totals and shares over the long history."""
    return class_shares(newest_history(spark, folder, LONG))


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative + positive AS BIGINT) AS volume,
           CAST(sum(negative) OVER w AS BIGINT) AS trailing_negative,
           CAST(sum(positive) OVER w AS BIGINT) AS trailing_positive,
           CAST(sum(negative + positive) OVER w AS BIGINT) AS trailing_volume
    FROM history
    WINDOW w AS (ORDER BY batch_ts ROWS BETWEEN {SHORT - 1} PRECEDING AND CURRENT ROW)
    """
)
def trailing_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Every hour with the totals of the 15 non-empty hours that end with it."""
    history = with_volume(
        sentiment_history(predictions(spark, folder), copies=F.col("copies"))
    )
    day = F.col("batch_ts").cast("date")
    # One row per batch from a pass over all texts. It is numbered from two sides, so it is written.
    dense = numbered(written(history, "history"), F.col("batch_ts"), day)
    return trailing_sum(dense, "idx", ["negative", "positive", "volume"], SHORT).select(
        "batch_ts", "volume", "trailing_negative", "trailing_positive", "trailing_volume"
    )
