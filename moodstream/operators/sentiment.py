"""Sentiment counts per batch and what the live views derive from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_predictions(
    predictions: DataFrame, by: str = "batch_ts", copies: str | None = None
) -> DataFrame:
    """Messages per batch and predicted class."""
    total = F.count("*") if copies is None else F.sum(copies)
    return predictions.groupBy(by, "prediction").agg(total.alias("cnt"))


def sentiment_history(
    predictions: DataFrame, by: str | Column = "batch_ts", copies: Column | None = None
) -> DataFrame:
    """One row per batch: negative and positive messages, absent classes as 0."""
    copies = F.lit(1).cast("bigint") if copies is None else copies
    return predictions.groupBy(by).agg(
        F.sum(F.when(F.col("prediction") == 0, copies).otherwise(0)).alias("negative"),
        F.sum(F.when(F.col("prediction") == 1, copies).otherwise(0)).alias("positive"),
    )


def with_volume(history: DataFrame) -> DataFrame:
    """Fill absent sides with 0 and add their sum."""
    return history.withColumns(
        {side: F.coalesce(side, F.lit(0)).cast("bigint") for side in ("negative", "positive")}
    ).withColumn("volume", F.col("positive") + F.col("negative"))


def recent_history(history: DataFrame, n: int) -> DataFrame:
    """The n newest batches, oldest first, with their position 1..n on the time axis."""
    newest = history.orderBy(F.desc("batch_ts")).limit(n)
    position = F.row_number().over(Window.orderBy("batch_ts"))  # at most n rows
    return (
        with_volume(newest).withColumn("position", position.cast("bigint")).orderBy("batch_ts")
    )


def axis_bounds(history: DataFrame) -> DataFrame:
    """Axis limits of a history: position, volume, and both classes together."""
    return history.agg(
        F.min("position").alias("min_position"),
        F.max("position").alias("max_position"),
        F.min("volume").alias("min_volume"),
        F.max("volume").alias("max_volume"),
        F.least(F.min("negative"), F.min("positive")).alias("min_sentiment"),
        F.greatest(F.max("negative"), F.max("positive")).alias("max_sentiment"),
    )


def class_shares(history: DataFrame) -> DataFrame:
    """Total and share per class over a history: two rows."""
    sides = F.array(
        F.struct(F.lit("Positive").alias("label"), F.sum("positive").alias("cnt")),
        F.struct(F.lit("Negative").alias("label"), F.sum("negative").alias("cnt")),
    )
    total = F.sum("positive") + F.sum("negative")
    share = F.col("cnt") / F.nullif(F.col("total"), F.lit(0))
    return (
        history.agg(sides.alias("sides"), total.alias("total"))
        .select(F.inline("sides"), "total")
        .select("label", "cnt", share.alias("share"))
    )
