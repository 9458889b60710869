"""Lines that many documents share, dropped wherever they stand.

Texts are split at \\n and their lines exploded under a key: the line without [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased. Keys are
hashed to 16 bytes of SHA-256. A row counts each of its keys once, so the number of documents of a key is a plain sum, added up before the
shuffle. Keys of at least `least_chars` code points in at least `least_docs` documents are common. Lines meet the common hashes in a join, the
positions found are gathered per document, and the text is put together again from its other lines by position.

What travels: hashes (a row per line, no line text) and each text once. A line that a third of the documents hold is one row per task in
the count; in the join its rows can be split between tasks, because the other side is one row. Positions of one document
are as many as its lines. Everything is built-in functions.

Every row is a document of its own, so a repeated row counts again; equal rows lose the same lines. Null text: as the empty text, one empty
line, whose key is too short to be dropped. Very long texts and lines are handled whole. Ties cannot arise. Null keys are kept as such.
Columns besides key and text are not read, so clashing names do no harm. An empty table gives an empty result.
"""

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.shared import written

BLANK = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 1, 10


def normalised(line: Column) -> Column:
    """The key of a line. For ASCII, `lower` changes A-Z alone; other lines are mapped letter by letter."""
    bare = F.btrim(line, F.lit(BLANK))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hashes(text: Column, least_chars: int) -> Column:
    """Hash of every line, null for a key that is too short."""

    def hashed(line: Column) -> Column:
        return F.get(F.transform(F.array(normalised(line)), lambda k: F.when(F.char_length(k) >= least_chars, _digest(k))), F.lit(0))

    return F.transform(_lines(text), hashed)


def common_lines(texts: DataFrame, text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(hash, docs) of the keys found in at least least_docs rows."""
    once = F.array_distinct(_hashes(F.coalesce(F.col(text), F.lit("")), least_chars))
    return (
        texts.select(F.explode(once).alias("hash"))
        .filter("hash is not null")
        .groupBy("hash")
        .agg(F.count("*").alias("docs"))
        .filter(F.col("docs") >= least_docs)
    )


def without_common_lines(
    frame: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """(key, text without its common lines, n_lines, n_dropped) of every row."""
    docs = frame.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    common = written(common_lines(docs, "text", least_chars, least_docs).select("hash"), "common-lines")
    own = docs.withColumn("digest", _digest(F.col("text")))
    places = own.select("key", "digest", F.posexplode(_hashes(F.col("text"), least_chars)).alias("pos", "hash"))
    found = places.filter("hash is not null").join(common, "hash").groupBy("key", "digest").agg(F.collect_set("pos").alias("dropped"))
    found = found.withColumnsRenamed({"key": "of", "digest": "of_digest"})
    joined = own.join(found, F.col("key").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    none = F.array().cast("array<int>")

    def kept(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(F.col("dropped"), none))
        return F.struct(
            F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n").alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(left)).cast("long").alias("n_dropped"),
        )

    # The one-element array evaluates the split once per row.
    return joined.select("key", F.inline(F.transform(F.array(_lines(F.col("text"))), kept))).withColumnRenamed("key", key)
