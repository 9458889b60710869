"""The stream jobs.

`start_windows` cuts batches by event time. A micro-batch adds what it has to each window, so
there is no state, a late message still counts, and a window that is open at the end is there. `start_micro_batches` takes every micro-batch as a batch
by itself, as it arrives. Both are one query, whose micro-batch is decoded once, feeds all outputs and is committed once.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodstream.functions.clock import window_start
from moodstream.functions.text import tokens
from moodstream.operators.model import LinearModel, score_messages
from moodstream.operators.recent import recent_per_batch
from moodstream.operators.sentiment import count_predictions, sentiment_history
from moodstream.operators.words import by_batch, count_words, explode_words, top_words
from moodstream.streaming.folders import release
from moodstream.streaming.tables import SHOWN, TOP, Closing, Outputs, ServingTables, add_batch, run_of

OUTPUTS = ("words", "recent_text", "sentiment")

#: Stand among the words for a message of a class. No word has their first sign.
CLASSES = ("-0", "-1")

#: State is kept by RocksDB on the executors' disks, in so many MB of an executor at most: on the heap it would grow with the ids of all messages.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def trigger_options(every: str | None) -> dict:
    """A processing-time trigger, or with None one that ends when all available input is done."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def windowed_words(messages: DataFrame, window: str) -> DataFrame:
    """(batch_ts, word, cnt) per window."""
    placed = messages.select(window_start(F.col("event_ts"), window).alias("batch_ts"), "text")
    return count_words(explode_words(by_batch(placed), ["batch_ts"]), ["batch_ts"])


def windowed_sentiment(messages: DataFrame, model: LinearModel, window: str) -> DataFrame:
    """(batch_ts, negative, positive) per window, of messages that may have their `prediction` already."""
    scored = messages if "prediction" in messages.columns else score_messages(messages, model)
    history = sentiment_history(scored, F.window("event_ts", window).alias("w"))
    return history.select(F.col("w.start").alias("batch_ts"), "negative", "positive")


def windowed_both(messages: DataFrame, model: LinearModel, window: str) -> DataFrame:
    """(batch_ts, word, cnt) per window, where a message also has the one of CLASSES it is predicted to be in: texts are taken apart once for both."""
    placed = messages.select(window_start(F.col("event_ts"), window).alias("batch_ts"), "text")
    raw = by_batch(placed).withColumn("raw", F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")))
    scored = score_messages(raw, model, F.col("raw"))
    predicted = F.when(F.col("prediction") == 0, CLASSES[0]).otherwise(CLASSES[1])
    return count_words(explode_words(scored, ["batch_ts"], F.concat("raw", F.array(predicted))), ["batch_ts"])


class WindowOutputs:
    """What a micro-batch adds to its windows, by table."""

    def __init__(self, model: LinearModel, window: str, outputs: tuple[str, ...], shown: int):
        self.model, self.window, self.outputs, self.shown = model, window, outputs, shown

    def narrowed(self, messages: DataFrame) -> DataFrame:
        """What is kept of messages while the outputs are made. Where only their predictions are asked for, that is no text."""
        if self.outputs != ("sentiment",):
            return messages
        source = ["source"] if "source" in messages.columns else []
        return score_messages(messages, self.model).select(*source, "event_ts", "prediction")

    def __call__(self, messages: DataFrame) -> dict[str, DataFrame]:
        batched = messages.withColumn("batch_ts", window_start(F.col("event_ts"), self.window))
        made = {
            "words": lambda: windowed_words(messages, self.window),
            "recent_text": lambda: recent_per_batch(batched, self.shown),
            "sentiment": lambda: windowed_sentiment(messages, self.model, self.window),
        }
        kept = []
        if {"words", "sentiment"} <= set(self.outputs):
            both = windowed_both(messages, self.model, self.window).persist()
            kept.append(both)
            named = F.col("word").isin(*CLASSES)
            classes = both.filter(named).select("batch_ts", F.when(F.col("word") == CLASSES[0], 0).otherwise(1).alias("prediction"), "cnt")
            made["words"] = lambda: both.filter(~named)
            made["sentiment"] = lambda: sentiment_history(classes, copies=F.col("cnt"))
        return Outputs({name: made[name]() for name in self.outputs}, kept)


def window_outputs(model: LinearModel, window: str, outputs: tuple[str, ...] = OUTPUTS, shown: int = SHOWN) -> WindowOutputs:
    """What a micro-batch adds to its windows, by table."""
    return WindowOutputs(model, window, tuple(outputs), shown)


def micro_batch_outputs(model: LinearModel, epoch: int, show: bool = False):
    """What a micro-batch is by itself, by table.

    The batch time is the newest arrival in the micro-batch, which a retry reproduces, and a microsecond
    for each micro-batch before, so that two with the same newest arrival stay apart and in order.
    """

    def frames(messages: DataFrame) -> dict[str, DataFrame]:
        newest = messages.agg(F.max(F.unix_millis("arrived_at"))).first()[0]
        batch_ts = F.timestamp_micros(F.lit(None if newest is None else newest * 1000 + epoch).cast("bigint"))
        stamped = messages.withColumn("batch_ts", batch_ts)
        scored = score_messages(stamped, model).select("batch_ts", "prediction")
        if show:
            count_predictions(scored).show()
        return {
            "words": top_words(count_words(explode_words(stamped, ["batch_ts"]), ["batch_ts"]), TOP),
            "recent_text": recent_per_batch(stamped, SHOWN),
            "sentiment": sentiment_history(scored),
        }

    return frames


def _writer(outputs_of, tables: ServingTables, run: str, closing: Closing | None = None):
    """Write all outputs of a micro-batch and commit them together.

    Texts are kept in memory or on disk of the executors while the outputs are made; nothing of them comes to
    the driver.
    """

    def write(messages: DataFrame, epoch: int) -> None:
        release(messages.sparkSession)  # of the micro-batches before, else the disks fill up with the texts of all
        add_batch(messages, tables, run, epoch, outputs_of(epoch), closing=closing, streamed=True)

    return write


def write_windows(model: LinearModel, tables: ServingTables, window: str, run: str, outputs: tuple[str, ...] = OUTPUTS):
    """All outputs of a micro-batch of the window job."""
    frames = window_outputs(model, window, outputs)
    return _writer(lambda epoch: frames, tables, run)


def write_micro_batch(model: LinearModel, tables: ServingTables, run: str, show: bool = False):
    """All outputs of one micro-batch that is a batch by itself."""
    return _writer(lambda epoch: micro_batch_outputs(model, epoch, show), tables, run)


def start_windows(
    messages: DataFrame,
    model: LinearModel,
    tables: ServingTables,
    window: str = "1 second",
    every: str | None = "1 second",
    run: str | None = None,
    outputs: tuple[str, ...] = OUTPUTS,
) -> list[StreamingQuery]:
    """Start the job: one query for all outputs. `run` is by default the identity of the checkpoint."""
    checkpoint = tables.checkpoint("windows")
    run = run or run_of(messages.sparkSession, checkpoint)
    return [_started(messages, write_windows(model, tables, window, run, outputs), checkpoint, f"windows-{run}", every)]


def start_micro_batches(
    messages: DataFrame,
    model: LinearModel,
    tables: ServingTables,
    every: str | None = "1 second",
    run: str | None = None,
    show: bool = False,
) -> StreamingQuery:
    """One query for all outputs. `messages` also carries `arrived_at`. `run` is by default the checkpoint's identity."""
    checkpoint = tables.checkpoint("all")
    run = run or run_of(messages.sparkSession, checkpoint)
    return _started(messages, write_micro_batch(model, tables, run, show), checkpoint, f"all-{run}", every)


def start_final_words(
    messages: DataFrame, tables: ServingTables, window: str = "1 second", delay: str = "1 minute", every: str | None = "1 second", run: str | None = None
) -> StreamingQuery:
    """Write the top words of every window once, when it is closed: when the newest event is `delay` past its end. Messages that come later are dropped."""
    checkpoint = tables.checkpoint("final-words")
    run = run or run_of(messages.sparkSession, checkpoint)
    write = _writer(lambda epoch: lambda counted: {"open": windowed_words(counted, window)}, tables, run, Closing(window, delay))
    return _started(messages, write, checkpoint, f"final-words-{run}", every)


def _started(messages: DataFrame, write, checkpoint: str, name: str, every: str | None) -> StreamingQuery:
    """Start a query; it takes the settings of its state along from the session. A checkpoint that another store has begun goes on with that one."""
    conf = messages.sparkSession.conf
    before = {key: conf.get(key, None) for key in STATE}
    try:
        for key, value in STATE.items():
            conf.set(key, value)
        return (
            messages.writeStream.option("checkpointLocation", checkpoint)
            .queryName(name)
            .foreachBatch(write)
            .trigger(**trigger_options(every))
            .start()
        )
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def start_console(history: DataFrame, every: str | None = "1 second") -> StreamingQuery:
    """Print rows as they are finished."""
    return (
        history.writeStream.format("console")
        .outputMode("append")
        .trigger(**trigger_options(every))
        .start()
    )


def start_quarantine(
    bad: DataFrame, tables: ServingTables, every: str | None = "1 second"
) -> StreamingQuery:
    """Keep payloads that could not be read. The file sink's log makes retries harmless."""
    return (
        bad.writeStream.format("parquet")
        .option("path", tables.quarantine)
        .option("checkpointLocation", tables.checkpoint("quarantine"))
        .trigger(**trigger_options(every))
        .start()
    )


def publish(payloads: DataFrame, servers: str, topic: str) -> None:
    """Send (value) rows to a Kafka topic. Needs Spark's Kafka connector package."""
    (
        payloads.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def start_publishing(
    payloads: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Forward a stream of (value) rows to a Kafka topic."""
    return (
        payloads.select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every))
        .start()
    )


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; a failure of one is raised here."""
    for query in queries:
        query.awaitTermination()

