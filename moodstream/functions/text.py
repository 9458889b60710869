"""Placeholders and tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder terms and the default patterns they stand for.
RETWEET_TERM = "retweetplaceholder"
MENTION_TERM = "pseudoplaceholder"
HASHTAG_TERM = "hashtagplaceholder"
LINK_TERM = "linkplaceholder"

RETWEET_PATTERN = r"rt:"
MENTION_PATTERN = r"\@[a-zA-Z0-9_]*"
HASHTAG_PATTERN = r"\#[a-zA-Z0-9_]*"
LINK_PATTERN = r"http(s)?://[a-zA-Z0-9./\-]*"

# Order in which the terms follow the common words in a vocabulary.
VOCABULARY_TAIL = (MENTION_TERM, LINK_TERM, RETWEET_TERM, HASHTAG_TERM)

# Unicode letters, digits and underscore. Java's own \w knows ASCII only.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def with_placeholders(
    text: Column,
    mention: str = MENTION_PATTERN,
    link: str = LINK_PATTERN,
    hashtag: str = HASHTAG_PATTERN,
    retweet: str = RETWEET_PATTERN,
) -> Column:
    """Replace message markup by terms.

    Retweet marks go first and links last, so a link's fragment has already become a hashtag
    term when the link pattern runs and is absorbed by it.
    """
    replaced = F.regexp_replace(text, retweet, RETWEET_TERM)
    replaced = F.regexp_replace(replaced, mention, MENTION_TERM)
    replaced = F.regexp_replace(replaced, hashtag, HASHTAG_TERM)
    replaced = F.regexp_replace(replaced, link, LINK_TERM)
    if (retweet, mention, hashtag, link) != (
        RETWEET_PATTERN,
        MENTION_PATTERN,
        HASHTAG_PATTERN,
        LINK_PATTERN,
    ):
        return replaced
    return F.when(has_marks(text), replaced).otherwise(text)


def has_marks(text: Column) -> Column:
    """Whether a text may hold message markup: one without these marks cannot match the default patterns. Looking for bytes is far cheaper than matching."""
    marked = F.lit(False)
    for mark in ("@", "#", "rt:", "http"):
        marked = marked | F.contains(text, F.lit(mark))
    return marked


def tokens(text: Column, word: str = WORD_PATTERN) -> Column:
    """Lower-cased words of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(word), F.lit(0))


def feature_tokens(text: Column, raw: Column | None = None) -> Column:
    """Tokens the model sees: placeholders first, unlike the raw word count.

    `raw`: the text's own tokens, where they are known; those of a text without markup are the same.
    """
    if raw is None:
        return tokens(with_placeholders(text))
    return F.when(has_marks(text), tokens(with_placeholders(text))).otherwise(raw)


def has_token(text: Column, word: str = WORD_PATTERN) -> Column:
    """True if a text has at least one word; stops at the first one."""
    return F.lower(text).rlike(word)


def token_rows(text: Column) -> Column:
    """One row per token of a text.

    The outer form yields a null word for a text without words, which callers drop. With the plain
    form the optimizer adds "size(tokens) > 0 and tokens is not null" below the generator and the
    pattern then runs three times per text.
    """
    return F.explode_outer(text)
