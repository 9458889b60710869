"""Word clouds: font sizes and colours for a short list of words."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.scores import (
    drawn_score,
    font_size,
    half_step,
    normalised_count,
    score_band,
    size_spread,
)


def cloud(
    words: DataFrame,
    scores: str | None = None,
    limit: int | None = None,
    compat: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """(word, cnt, font_size) and, with scores "count" or "random", (score, colour).

    Meant for top lists: range and order are taken over all given words, a few hundred at most.
    The range covers the words before `limit` applies. `compat` picks the alphabetically last words
    instead of the most frequent ones and uses the literal normalisation, see `normalised_count`.
    """
    everything = Window.partitionBy()
    ranged = words.withColumns(
        {
            "_smallest": F.min("cnt").over(everything),
            "_spread": size_spread(F.min("cnt").over(everything), F.max("cnt").over(everything)),
        }
    )
    count, smallest, spread = F.col("cnt"), F.col("_smallest"), F.col("_spread")
    sized = ranged.withColumn("font_size", font_size(count, smallest, spread))
    if scores == "count":
        sized = sized.withColumn("score", normalised_count(count, smallest, spread, compat))
    elif scores == "random":
        sized = sized.withColumn("score", drawn_score(F.col("word"), seed))
    if scores is not None:
        sized = sized.withColumn("colour", score_band(half_step(F.col("score"))))
    if limit is not None:
        order = [F.desc("word")] if compat else [F.desc("cnt"), F.asc("word")]
        sized = sized.orderBy(*order).limit(limit)
    return sized.drop("_smallest", "_spread")
