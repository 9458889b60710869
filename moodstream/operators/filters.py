"""Row filters."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_language(lang: str = "en") -> Column:
    """Exact language match; reaches the Parquet scan as a pushed filter."""
    return F.col("lang") == lang


def nonempty_text() -> Column:
    """Text that is neither missing nor empty."""
    return F.col("text") != ""


def keep_messages(messages: DataFrame, lang: str = "en") -> DataFrame:
    """Non-empty messages in one language. A missing language or text drops the row."""
    return messages.filter(in_language(lang) & nonempty_text())


def track(messages: DataFrame, subjects: str | Sequence[str]) -> DataFrame:
    """Messages whose text holds any of the subjects, upper or lower case.

    Blanks around a subject and empty subjects do not count; without any subject there is nothing to track.
    Plain substring tests, which for a handful of subjects are about twice as fast as one pattern; the text is lowered once.
    """
    given = subjects.split(",") if isinstance(subjects, str) else subjects
    wanted = [x.strip().lower() for x in given if x.strip()]
    if not wanted:
        raise ValueError("no subject to track")
    lowered = F.transform(F.array(F.lower("text")), lambda text: reduce(or_, (F.contains(text, F.lit(x)) for x in wanted)))
    return messages.filter(F.get(lowered, F.lit(0)))


def without_keyword(words: DataFrame, keyword: str) -> DataFrame:
    """Drop the tracked keyword, which would dwarf all other words. It need not be there."""
    return words.filter(F.col("word") != keyword)


def take_first(messages: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n messages in an order. On a stream use the reader's rate options instead."""
    return messages.orderBy(*order).limit(n)
