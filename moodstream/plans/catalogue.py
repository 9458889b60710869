"""All registered queries."""

from moodstream.plans import sentiment, serving, stored, streams, text, training, words  # noqa: F401
from moodstream.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
