"""Recent messages."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.operators.ranking import top_per_group


def newest_first() -> list[Column]:
    """Newest first; the id decides between messages of the same instant."""
    return [F.desc("event_ts"), F.desc("id")]


def recent_per_batch(texts: DataFrame, k: int = 5, by: str | Sequence[str] = "batch_ts") -> DataFrame:
    """k newest messages of every batch."""
    return top_per_group(texts, by, newest_first(), k)


def as_table(texts: DataFrame, rows: int = 5) -> DataFrame:
    """The newest messages under the headings of the page, times cut to whole seconds."""
    return titled(
        texts.orderBy(*newest_first())
        .limit(rows)
        .select(
            F.substring("created_at", 1, 19).alias("time"),
            F.col("text").alias("tweet"),
            "author",
        )
    )


def titled(frame: DataFrame) -> DataFrame:
    """Column names in title case."""
    return frame.withColumnsRenamed({name: name.title() for name in frame.columns})
