"""All queries of this package."""

from moodstream.llm import (  # noqa: F401
    bpe_query,
    collocations_query,
    language_query,
    license_query,
    lines_query,
    mixing_query,
    pii_query,
    quality_query,
    resampling_query,
    simhash_query,
    spotsigs_query,
    substrings_query,
    warc_query,
)
from moodstream.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
