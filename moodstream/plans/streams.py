"""The stream jobs run over the test tables until these are read to the end."""

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.plans.messages import BATCH, STREAM_SQL, message_tasks, tokens_sql
from moodstream.plans.registry import query
from moodstream.plans.sentiment import HISTORY_SQL, MODEL, scored_sql
from moodstream.plans.serving import SHOWN, recent_per_window_sql
from moodstream.plans.words import TOP, TOP_SQL
from moodstream.sources.readers import source, table
from moodstream.streaming.folders import new_folder
from moodstream.streaming.jobs import await_all, start_final_words, start_micro_batches, start_windows, write_windows
from moodstream.streaming.sources import delivered_once, good_messages
from moodstream.streaming.tables import (
    ServingTables,
    compact,
    read_latest,
    read_recent_text,
    read_sentiment,
    read_words,
)

CHUNKS = 4  # files of the streams that take several micro-batches
GROUP = 4 << 20  # bytes of a row group in the files that a stream reads: a row group is read by one task


def payload_stream(spark: SparkSession, folder: str, files: str | None = None, max_files: int | None = None) -> DataFrame:
    """Events as a stream of JSON payloads, as a topic would deliver them. `files`: a path or pattern in place of the table.

    Message times are written in UTC, the time zone of the tables. Events are short and messages long, so events are dealt out before they meet their texts:
    otherwise the few tasks that read them, or that a join makes of their bytes, would have all messages to write, parse and count.
    """
    path = f"{folder}/events.parquet"
    documents = table(spark, folder, "documents")
    total = documents.count()
    tasks = message_tasks(spark, folder)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream takes no single file as its path, but a pattern that only that file or folder fits.
    events = reader.parquet(files or f"{folder}/events.parque[t]").withColumn("source", source(F.col("_metadata.file_path")))
    texts = documents.select("doc_id", "text", "lang").repartition(tasks, "doc_id")
    carried = events.withColumn("doc_id", F.col("event_id") % total).repartition(tasks, "doc_id").join(texts, "doc_id")
    message = F.struct(
        F.col("event_id").alias("id"),
        F.concat(F.col("ts").cast("string"), F.lit("Z")).alias("created_at"),
        "text",
        "lang",
        F.struct(F.col("user_id").cast("string").alias("screen_name")).alias("user"),
    )
    arrived = F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("Z")))
    return carried.select(F.to_json(message).alias("payload"), arrived.alias("arrived_at"), "source")


def chunked(spark: SparkSession, folder: str) -> str:
    """The events as CHUNKS files by event_id % CHUNKS; the folder they are in."""
    path = new_folder(spark, "events")
    events = table(spark, folder, "events").withColumn("chunk", F.col("event_id") % CHUNKS)
    events.repartition("chunk").write.option("parquet.block.size", GROUP).partitionBy("chunk").parquet(path)
    return path


def utc(ts: str) -> Column:
    """Wall-clock time in UTC of an instant."""
    zone = F.current_timezone()
    return F.convert_timezone(zone, F.lit("UTC"), F.col(ts).cast("timestamp_ntz"))


def run_windows(spark: SparkSession, folder: str, output: str) -> ServingTables:
    """Run one output of the window job to the end of the input."""
    tables = ServingTables(new_folder(spark, f"streamed-{output}"))
    messages = good_messages(payload_stream(spark, folder))
    await_all(
        start_windows(
            messages, MODEL, tables, BATCH, every=None, outputs=(output,),
        )
    )
    return tables


@query(f"WITH {TOP_SQL} SELECT * FROM top")
def streamed_word_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Word count history written by the window job."""
    tables = run_windows(spark, folder, "words")
    return read_words(spark, tables).select(utc("batch_ts").alias("batch_ts"), "word", "cnt")


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive
    FROM history
    """
)
def streamed_sentiment_history(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment history written by the window job."""
    tables = run_windows(spark, folder, "sentiment")
    return read_sentiment(spark, tables).select(
        utc("batch_ts").alias("batch_ts"), "negative", "positive"
    )


@query(recent_per_window_sql(SHOWN))
def streamed_recent_text(spark: SparkSession, folder: str) -> DataFrame:
    """Recent messages per hour written by the window job."""
    tables = run_windows(spark, folder, "recent_text")
    return read_recent_text(spark, tables, SHOWN).select(
        utc("batch_ts").alias("batch_ts"), "id", "author", "text"
    )


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT CAST(sum(negative) AS BIGINT) AS negative, CAST(sum(positive) AS BIGINT) AS positive
    FROM history
    """
)
def streamed_micro_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of the sentiment history written by the micro-batch job."""
    tables = ServingTables(new_folder(spark, "streamed-micro"))
    messages = good_messages(payload_stream(spark, folder))
    await_all([start_micro_batches(messages, MODEL, tables, every=None)])
    return read_sentiment(spark, tables).agg(
        F.sum("negative").alias("negative"), F.sum("positive").alias("positive")
    )


@cache
def _micro_batches(session: str, folder: str) -> ServingTables:
    spark = SparkSession.active()
    tables = ServingTables(new_folder(spark, "streamed-micro"))
    payloads = payload_stream(spark, folder, f"{chunked(spark, folder)}/chunk=*", max_files=1)
    await_all([start_micro_batches(good_messages(payloads), MODEL, tables, every=None)])
    return tables


def micro_batches(spark: SparkSession, folder: str) -> ServingTables:
    """Tables of the micro-batch job after CHUNKS micro-batches; made once per session and folder."""
    return _micro_batches(spark.sparkContext.applicationId, folder)


def shown_time(ts: str) -> Column:
    """The newest arrival of a micro-batch: its batch time without the microseconds that tell batches apart."""
    return F.date_trunc("millisecond", utc(ts)).cast("timestamp_ntz")


# A chunk is a micro-batch; its time is its newest message.
MICRO_SQL = f"""{STREAM_SQL},
micro AS (SELECT *, date_trunc('millisecond', max(ts) OVER (PARTITION BY event_id % {CHUNKS})) AS micro_ts, event_id % {CHUNKS} AS chunk FROM stream),
micro_counts AS (SELECT chunk, micro_ts, word, count(*) AS cnt
  FROM (SELECT chunk, micro_ts, unnest({tokens_sql("text")}) AS word FROM micro) GROUP BY chunk, micro_ts, word),
micro_words AS (SELECT * FROM micro_counts QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY cnt DESC, word) <= {TOP})"""


@query(f"WITH {MICRO_SQL} SELECT micro_ts AS batch_ts, word, cnt FROM micro_words")
def streamed_micro_words(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of every micro-batch."""
    words = read_words(spark, micro_batches(spark, folder))
    return words.select(shown_time("batch_ts").alias("batch_ts"), "word", "cnt")


@query(f"WITH {MICRO_SQL} SELECT micro_ts AS batch_ts, word, cnt FROM micro_words WHERE micro_ts = (SELECT max(micro_ts) FROM micro_words)")
def streamed_micro_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot after the last micro-batch."""
    words = read_latest(spark, micro_batches(spark, folder))
    return words.select(shown_time("batch_ts").alias("batch_ts"), "word", "cnt")


@query(
    f"""
    WITH {MICRO_SQL}, {scored_sql("stream", "event_id")}
    SELECT micro_ts AS batch_ts, count_if(prediction = 0)::BIGINT AS negative, count_if(prediction = 1)::BIGINT AS positive
    FROM micro JOIN scored USING (event_id) GROUP BY chunk, micro_ts
    """
)
def streamed_micro_history(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment of every micro-batch."""
    history = read_sentiment(spark, micro_batches(spark, folder))
    return history.select(shown_time("batch_ts").alias("batch_ts"), "negative", "positive")


@query(
    f"""
    WITH {MICRO_SQL}
    SELECT micro_ts AS batch_ts, event_id AS id, CAST(user_id AS VARCHAR) AS author, text FROM micro
    QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY ts DESC, event_id DESC) <= {SHOWN}
    """
)
def streamed_micro_recent(spark: SparkSession, folder: str) -> DataFrame:
    """The newest messages of every micro-batch."""
    texts = read_recent_text(spark, micro_batches(spark, folder))
    return texts.select(shown_time("batch_ts").alias("batch_ts"), "id", "author", "text")


@cache
def _restarted(session: str, folder: str) -> ServingTables:
    spark = SparkSession.active()
    tables = ServingTables(new_folder(spark, "streamed-restarted"))
    files = chunked(spark, folder)

    def run(name: str, chunks: str) -> None:
        """A run with a checkpoint of its own over some chunks."""
        messages = good_messages(payload_stream(spark, folder, f"{files}/chunk={chunks}", max_files=1))
        write = write_windows(MODEL, tables, BATCH, name)
        stream = messages.writeStream.option("checkpointLocation", tables.checkpoint(name)).foreachBatch(write)
        await_all([stream.trigger(availableNow=True).start()])

    run("first", "[01]")
    run("from-start", "[012]")  # the checkpoint is lost: all is read again, and one chunk more
    compact(spark, tables)
    run("from-latest", "3")  # lost again: this run begins with what is new
    return tables


def restarted(spark: SparkSession, folder: str) -> ServingTables:
    """Tables of the window job whose checkpoint was lost twice, compacted in between; made once per session and folder."""
    return _restarted(spark.sparkContext.applicationId, folder)


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive
    FROM history
    """
)
def streamed_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """Every message counts once, whatever was read again."""
    history = read_sentiment(spark, restarted(spark, folder))
    return history.select(utc("batch_ts").alias("batch_ts"), "negative", "positive")


@query(f"WITH {TOP_SQL} SELECT * FROM top")
def streamed_restarted_words(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the words."""
    return read_words(spark, restarted(spark, folder)).select(utc("batch_ts").alias("batch_ts"), "word", "cnt")


def delivery(spark: SparkSession, folder: str, path: str, number: int) -> None:
    """Write one more file of events: about a week each, and of every tenth event the week before, which comes late."""
    week = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (7 * 86_400 * 1_000_000))
    events = table(spark, folder, "events").withColumn("week", week)
    first = events.agg(F.min("week")).scalar()
    due = F.col("week") - first + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    events.filter(due == number).drop("week").repartition(1).write.option("parquet.block.size", GROUP).mode("append").parquet(path)


WEEKS = 7  # files: January in calendar weeks, and the late ones


@query(
    f"""
    WITH {TOP_SQL}, seen AS (SELECT max(ts) AS newest FROM stream)
    SELECT top.* FROM top, seen WHERE batch_ts + INTERVAL 1 HOUR <= newest - INTERVAL 15 DAY
    """
)
def streamed_final_words(spark: SparkSession, folder: str) -> DataFrame:
    """Top words of every hour that is closed, written once, though a tenth of the messages comes a week late."""
    path, tables = new_folder(spark, "deliveries"), ServingTables(new_folder(spark, "streamed-final"))
    for number in range(WEEKS):  # one after the other: files are taken by their time
        delivery(spark, folder, path, number)
    messages = good_messages(payload_stream(spark, folder, path, max_files=1))
    await_all([start_final_words(messages, tables, BATCH, "15 days", every=None)])
    return read_words(spark, tables).select(utc("batch_ts").alias("batch_ts"), "word", "cnt")


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive
    FROM history
    """
)
def streamed_delivered_once(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment history of a stream that delivers every message twice, with a restart in between."""
    path, tables = new_folder(spark, "deliveries"), ServingTables(new_folder(spark, "streamed-once"))
    for number in range(2 * WEEKS):
        delivery(spark, folder, path, number // 2 if number < WEEKS else number - WEEKS)
        if number in (WEEKS - 1, 2 * WEEKS - 1):  # the first weeks twice, then all of them once more
            messages = delivered_once(good_messages(payload_stream(spark, folder, path, max_files=4)), "60 days")
            await_all(start_windows(messages, MODEL, tables, BATCH, every=None, outputs=("sentiment",)))
    return read_sentiment(spark, tables).select(utc("batch_ts").alias("batch_ts"), "negative", "positive")


@query(
    f"""
    WITH {HISTORY_SQL}
    SELECT batch_ts, CAST(negative AS BIGINT) AS negative, CAST(positive AS BIGINT) AS positive
    FROM history
    """
)
def streamed_every_second(spark: SparkSession, folder: str) -> DataFrame:
    """The job as it runs for good: triggered every second, with triggers that find nothing, until it is ended."""
    tables = ServingTables(new_folder(spark, "streamed-second"))
    messages = good_messages(payload_stream(spark, folder, f"{chunked(spark, folder)}/chunk=*", max_files=2))
    for job in start_windows(messages, MODEL, tables, BATCH, every="1 second", outputs=("sentiment",)):
        job.processAllAvailable()
        job.stop()
    return read_sentiment(spark, tables).select(utc("batch_ts").alias("batch_ts"), "negative", "positive")
