"""Messages and arrivals out of the test tables.

A document stands for the text of a message and an event for its arrival: event e carries document
e % n. The tables keep texts and arrivals apart, and the plans use that: texts are tokenised or scored
once per document, and arrivals travel as (document, batch, copies).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.clock import window_start
from moodstream.functions.text import has_token
from moodstream.operators.filters import keep_messages
from moodstream.sources.readers import table

BATCH = "1 hour"
MESSAGES = 25_000  # events of the table for each task that makes their messages


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as messages: id, text, lang, user.screen_name."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        "text",
        "lang",
        F.struct(F.col("source").alias("screen_name")).alias("user"),
    )


def english(spark: SparkSession, folder: str) -> DataFrame:
    """Non-empty English messages."""
    return keep_messages(messages(spark, folder))


def spread(frame: DataFrame, key: str = "id") -> DataFrame:
    """Deal a scanned table out by a unique key if its scan has too few tasks for the cluster.

    One row group is read by one task, however many cores wait. Taking texts apart costs more than
    moving them, so such a table is spread first. A table with enough row groups is left alone.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if 2 * frame.rdd.getNumPartitions() > cores:
        return frame
    return frame.repartition(cores, key)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of non-empty English messages."""
    return english(spark, folder).select(F.col("id").alias("doc_id"), "text")


def arrivals(spark: SparkSession, folder: str, since: Column | None = None) -> DataFrame:
    """Events with the document they carry and the batch they fall into.

    `since` is the start of a batch. It filters the raw time at the scan, before anything else.
    """
    documents = table(spark, folder, "documents").agg(F.count("*")).scalar()
    events = table(spark, folder, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= since)
    return events.select(
        "event_id",
        "ts",
        "user_id",
        (F.col("event_id") % documents).alias("doc_id"),
        window_start(F.col("ts"), BATCH).alias("batch_ts"),
    )


def copies(spark: SparkSession, folder: str, since: Column | None = None) -> DataFrame:
    """(doc_id, batch_ts, copies): a document that floods a batch becomes one row.

    The counts are combined in the map tasks. A document that makes up a third of all events is left
    with one row per batch, so it cannot outweigh the others in the joins that follow.
    """
    return (
        arrivals(spark, folder, since)
        .groupBy("doc_id", "batch_ts")
        .agg(F.count("*").alias("copies"))
    )


def message_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks among which the messages of all events are dealt out."""
    return max(2 * spark.sparkContext.defaultParallelism, table(spark, folder, "events").count() // MESSAGES)


def arrived_texts(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """(batch_ts, copies, text) of the whole history: a text once for each batch it arrived in. With `tasks`, dealt out by document to so many."""
    carried = texts(spark, folder)
    if tasks is not None:
        carried = carried.repartition(tasks, "doc_id")
    return copies(spark, folder).join(carried, "doc_id").select("batch_ts", "copies", "text")


def newest_copies(spark: SparkSession, folder: str, n: int, having: Column) -> DataFrame:
    """`copies` of the n newest batches with at least one message whose text fulfils `having`.

    The oldest of these batches is found from keys alone, before any text is tokenised.
    """
    useful = texts(spark, folder).filter(having).select("doc_id")
    newest = (
        copies(spark, folder)
        .join(useful, "doc_id", "left_semi")
        .select("batch_ts")
        .distinct()
        .orderBy(F.desc("batch_ts"))
        .limit(n)
    )
    return copies(spark, folder, since=newest.agg(F.min("batch_ts")).scalar())


def newest_word_copies(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """Arrivals of the n newest batches with at least one word."""
    return newest_copies(spark, folder, n, has_token(F.col("text")))


def newest_message_copies(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """Arrivals of the n newest batches with at least one message."""
    return newest_copies(spark, folder, n, F.lit(True))


# Check SQL: the same stand-in as a common table expression.
STREAM_SQL = """stream AS (
  SELECT e.event_id, e.ts, e.user_id, date_trunc('hour', e.ts) AS batch_ts, d.doc_id, d.text
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  WHERE d.lang = 'en' AND d.text <> ''
)"""

ENGLISH_SQL = """english AS (
  SELECT doc_id AS id, text FROM documents WHERE lang = 'en' AND text <> ''
)"""


def tokens_sql(text: str) -> str:
    """List of lower-cased words of a text."""
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')"


def placeholders_sql(text: str) -> str:
    """Text with placeholder terms."""
    for pattern, term in (
        ("rt:", "retweetplaceholder"),
        ("@[a-zA-Z0-9_]*", "pseudoplaceholder"),
        ("#[a-zA-Z0-9_]*", "hashtagplaceholder"),
        (r"http(s)?://[a-zA-Z0-9./\-]*", "linkplaceholder"),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{term}', 'g')"
    return text
