"""Word counts, vocabulary and features."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.text import feature_tokens, tokens
from moodstream.operators.features import build_vocabulary, join_vocabulary
from moodstream.operators.features import term_frequency as term_frequency_of
from moodstream.operators.heavy import heavy_words, holds
from moodstream.operators.words import (
    as_wide_rows,
    by_batch,
    count_words,
    explode_words,
    from_wide_rows,
    merge_counts,
    top_words,
)
from moodstream.plans.messages import (
    ENGLISH_SQL,
    STREAM_SQL,
    arrivals,
    arrived_texts,
    english,
    message_tasks,
    messages,
    newest_word_copies,
    placeholders_sql,
    spread,
    texts,
    tokens_sql,
)
from moodstream.plans.registry import query
from moodstream.sources.readers import read_vocabulary
from moodstream.streaming.folders import new_folder

TOP = 100  # words kept per batch
LONG = 5  # batches behind the long-term view
VOCABULARY = 1000  # common words in the vocabulary

COUNTS_SQL = f"""{STREAM_SQL},
counts AS (
  SELECT batch_ts, word, count(*) AS cnt
  FROM (SELECT batch_ts, unnest({tokens_sql('text')}) AS word FROM stream)
  GROUP BY batch_ts, word
)"""

TOP_SQL = f"""{COUNTS_SQL},
top AS (
  SELECT batch_ts, word, cnt FROM counts
  QUALIFY row_number() OVER (PARTITION BY batch_ts ORDER BY cnt DESC, word) <= {TOP}
)"""

VOCABULARY_SQL = f"""{ENGLISH_SQL},
common AS (
  SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS idx
  FROM (SELECT word, count(*) AS cnt
        FROM (SELECT unnest({tokens_sql('text')}) AS word FROM english) GROUP BY word)
  WHERE word NOT IN
    ('pseudoplaceholder', 'linkplaceholder', 'retweetplaceholder', 'hashtagplaceholder')
  QUALIFY idx < {VOCABULARY}
),
vocabulary AS (
  SELECT word AS term, idx FROM common
  UNION ALL
  SELECT term, (SELECT count(*) FROM common) + nth
  FROM (VALUES ('pseudoplaceholder', 0), ('linkplaceholder', 1),
               ('retweetplaceholder', 2), ('hashtagplaceholder', 3)) AS tail(term, nth)
)"""


def all_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_ts, word, cnt) of the whole history.

    Texts meet their arrivals by document and then travel on to their batches, where they are tokenised and counted.
    """
    words = explode_words(by_batch(arrived_texts(spark, folder)), ["batch_ts", "copies"])
    return count_words(words, ["batch_ts"], copies="copies")


def newest_counts(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """(batch_ts, word, cnt) of the n newest batches; only texts that arrived in them are tokenised."""
    carried = spread(texts(spark, folder), "doc_id")
    arrived = newest_word_copies(spark, folder, n).join(carried, "doc_id")
    words = explode_words(arrived, ["batch_ts", "copies"], tokens(F.col("text")))
    return count_words(words, ["batch_ts"], copies="copies")


def latest_top(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of the newest batch: what the `latest` snapshot holds."""
    return top_words(newest_counts(spark, folder, 1), TOP)


def long_totals(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    """Word totals over the newest batches, from their top lists or, if exact, from all words."""
    counts = newest_counts(spark, folder, LONG)
    return merge_counts(counts if exact else top_words(counts, TOP))


def english_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts over all English messages."""
    return count_words(explode_words(spread(english(spark, folder))))


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent English words and the placeholder terms."""
    return build_vocabulary(english_counts(spark, folder), VOCABULARY)


@query(f"WITH {COUNTS_SQL} SELECT * FROM counts")
def word_count_by_window(spark: SparkSession, folder: str) -> DataFrame:
    """Words per hour of arrival."""
    return all_counts(spark, folder)


@query(f"WITH {TOP_SQL} SELECT * FROM top")
def word_count_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Top words per hour of arrival."""
    return top_words(all_counts(spark, folder), TOP)


@query(f"WITH {TOP_SQL} SELECT * FROM top")
def wide_row_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Top words per hour through the wide-row form with one text cell per word."""
    return from_wide_rows(as_wide_rows(top_words(all_counts(spark, folder), TOP)))


@query(
    f"""
    WITH {ENGLISH_SQL}
    SELECT word, count(*) AS cnt
    FROM (SELECT unnest({tokens_sql('text')}) AS word FROM english) GROUP BY word
    """
)
def word_count_total(spark: SparkSession, folder: str) -> DataFrame:
    """Words over all English messages."""
    return english_counts(spark, folder)


@query(f"WITH {TOP_SQL} SELECT * FROM top WHERE batch_ts = (SELECT max(batch_ts) FROM top)")
def word_count_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of the newest hour."""
    return latest_top(spark, folder)


NEWEST_SQL = f"""
  batch_ts IN (SELECT DISTINCT batch_ts FROM counts ORDER BY batch_ts DESC LIMIT {LONG})"""


@query(
    f"""
    WITH {TOP_SQL}
    SELECT word, CAST(sum(cnt) AS BIGINT) AS cnt FROM top WHERE {NEWEST_SQL} GROUP BY word
    """
)
def word_count_long(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the top lists of the newest hours."""
    return long_totals(spark, folder)


@query(
    f"""
    WITH {COUNTS_SQL}
    SELECT word, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts WHERE {NEWEST_SQL} GROUP BY word
    """
)
def word_count_long_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over all words of the newest hours."""
    return long_totals(spark, folder, exact=True)


@query(f"WITH {VOCABULARY_SQL} SELECT term, idx FROM vocabulary")
def vocabulary_build(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabulary with indices."""
    return vocabulary(spark, folder)


@query(f"WITH {VOCABULARY_SQL} SELECT term, CAST(idx AS INTEGER) AS idx FROM vocabulary")
def vocabulary_file(spark: SparkSession, folder: str) -> DataFrame:
    """The vocabulary's own terms written as a text file, a term a line, and read back with their indices."""
    path = new_folder(spark, "terms")
    own = vocabulary(spark, folder).orderBy("idx").limit(VOCABULARY)
    own.select("term").coalesce(1).write.text(path)
    # The writer ends the last line too, which leaves an empty term, so that the placeholder terms come one later.
    found = read_vocabulary(spark, path).filter("term <> ''")
    return found.select("term", F.when(F.col("idx") < VOCABULARY, F.col("idx")).otherwise(F.col("idx") - 1).alias("idx"))


@query(
    f"""
    WITH {VOCABULARY_SQL},
    words AS (SELECT lang, unnest({tokens_sql(placeholders_sql('text'))}) AS word FROM documents)
    SELECT lang, count(*) AS n_tokens, count(term) AS n_hits,
           count(term) / count(*) AS hit_rate
    FROM words LEFT JOIN vocabulary ON word = term GROUP BY lang
    """
)
def vocab_hit_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Share of words in the vocabulary, per language."""
    words = explode_words(spread(messages(spark, folder)), ["lang"], feature_tokens(F.col("text")))
    hits = join_vocabulary(words, vocabulary(spark, folder), "left", VOCABULARY + 4)
    return (
        hits.groupBy("lang")
        .agg(F.count("*").alias("n_tokens"), F.count("idx").alias("n_hits"))
        .withColumn("hit_rate", F.col("n_hits") / F.col("n_tokens"))
    )


@query(
    f"""
    WITH {VOCABULARY_SQL},
    words AS (SELECT id, unnest({tokens_sql(placeholders_sql('text'))}) AS word FROM english)
    SELECT id, idx, count(*) AS tf FROM words JOIN vocabulary ON word = term GROUP BY id, idx
    """
)
def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Term frequencies of every English message."""
    return term_frequency_of(
        spread(english(spark, folder)), vocabulary(spark, folder), max_terms=VOCABULARY + 4
    )


PARTS = 50  # a heavy word makes up a fiftieth of its batch


@query(
    f"""
    WITH {COUNTS_SQL}
    SELECT batch_ts, word, CAST(cnt AS BIGINT) AS cnt FROM counts
    QUALIFY cnt * {PARTS} >= sum(cnt) OVER (PARTITION BY batch_ts)
    """
)
def heavy_words_by_window(spark: SparkSession, folder: str) -> DataFrame:
    """Words that make up a fiftieth of an hour's words, found by summaries.

    Summaries of any tasks add up, so as long as a task can hold those of all batches, texts are taken apart where they met their arrivals. Of a longer history
    they travel on to their batches, each once for every batch it arrived in, which is many times the documents.
    """
    batches = arrivals(spark, folder).select("batch_ts").distinct().count()
    if holds(batches, PARTS):
        arrived = arrived_texts(spark, folder, message_tasks(spark, folder))
    else:
        arrived = by_batch(arrived_texts(spark, folder))
    return heavy_words(explode_words(arrived, ["batch_ts", "copies"]), PARTS, copies="copies")
