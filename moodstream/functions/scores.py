"""Scales, score bands and rounding used by the live views."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colours of the five score bands, lowest first, with their upper limits.
BAND_LIMITS = (-1.0, -0.5, 0.0, 0.5)
BAND_COLOURS = ("#EE6055", "#FDE74C", "#FFE6AC", "#D0F2DF", "#9CEC5B")

# Row colours by polarity.
POSITIVE_COLOUR = "#002C0D"
NEGATIVE_COLOUR = "#270000"
NEUTRAL_COLOUR = "#0C0F0A"


def size_spread(smallest: Column, largest: Column) -> Column:
    """Width of a range of counts; at least 1 for a non-empty range."""
    return largest - smallest + 1


def font_size(count: Column, smallest: Column, spread: Column, max_change: float = 0.4) -> Column:
    """Font size in per cent: 120 at the middle of the range, max_change of it to either side."""
    position = F.bround((count - smallest) / spread * 2 - 1, 2)
    return (position * max_change + 1) * 120


def half_step(score: Column) -> Column:
    """Round to the nearest half, ties to even. Adding 0.0 turns a negative zero into zero."""
    return F.bround(score * 2, 0) / 2 + F.lit(0.0)


def score_band(score: Column) -> Column:
    """Colour of one of five score bands."""
    colour = F.lit(BAND_COLOURS[-1])
    for limit, name in reversed(list(zip(BAND_LIMITS, BAND_COLOURS))):
        colour = F.when(score < limit, name).otherwise(colour)
    return colour


def polarity(score: Column, threshold: float = 0.1) -> Column:
    """positive, negative or neutral around a dead zone."""
    return (
        F.when(score >= threshold, "positive")
        .when(score <= -threshold, "negative")
        .otherwise("neutral")
    )


def polarity_colour(score: Column, threshold: float = 0.1) -> Column:
    """Row colour for a score."""
    return (
        F.when(score >= threshold, POSITIVE_COLOUR)
        .when(score <= -threshold, NEGATIVE_COLOUR)
        .otherwise(NEUTRAL_COLOUR)
    )


def normalised_count(
    count: Column, smallest: Column, spread: Column, compat: bool = False
) -> Column:
    """Map a count into about [-0.49, 0.5].

    With compat the smallest count is taken off the spread a second time, which can turn the sign
    or divide by zero (null here).
    """
    width = F.nullif(spread - smallest, F.lit(0)) if compat else spread
    return (count - smallest) / width - 0.49


def random_score(seed: int | None = None) -> Column:
    """Uniform score in [-1, 1). Depends on the layout of the table, also with a seed."""
    return F.rand(seed) * 2 - 1


def drawn_score(word: Column, seed: int | None = None) -> Column:
    """Uniform score in [-1, 1), drawn by word and seed, so that a retried task or another layout gives the same."""
    drawn = F.md5(F.concat(F.lit(f"{'' if seed is None else seed}:"), word))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / 2**31 - 1


def outcome(prediction: Column, label: Column) -> Column:
    """Cell of the confusion matrix as text."""
    return F.concat(
        F.when(prediction == label, "True ").otherwise("False "),
        F.when(prediction == 1, "Positive").otherwise("Negative"),
    )
