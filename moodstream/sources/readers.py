"""Batch and streaming readers."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.text import VOCABULARY_TAIL
from moodstream.schemas import MESSAGE, MODEL
from moodstream.sources.payload import payload_text
from moodstream.sources.ranges import pieces, running


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def split_labelled_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """(sentiment, text) from `sentiment,text` lines.

    Only the first comma separates, as there is no quoting. The header is dropped; a line whose
    label is no integer has sentiment null, see `split_bad_labels`.
    """
    line = F.col(value)
    label = F.substring_index(line, ",", 1)
    comma = F.instr(line, ",")
    return lines.filter(label != "sentiment").select(
        label.try_cast("int").alias("sentiment"),
        F.when(comma > 0, F.substr(line, comma + 1)).alias("text"),
    )


def split_bad_labels(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and rows without an integer label or without a text."""
    good = F.col("sentiment").isNotNull() & F.col("text").isNotNull()
    return labelled.filter(good), labelled.filter(~good)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled sample from a text file."""
    return split_labelled_lines(spark.read.text(path))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(term, idx) from a file with one term per line, placeholder terms last.

    The position in the file is the index, also for the empty term that a final newline leaves.
    A repeated term keeps its last position. Lines are numbered by byte range, so a file may have any size.
    """
    lines = running(pieces(spark, path, "\n").withColumn("one", F.lit(1)), "one", "idx")
    lines = lines.select("size", "piece", F.col("idx").cast("int").alias("idx"))
    read = F.sum(F.octet_length("piece") + 1)
    closed = (F.max("size") == read).cast("int")  # ends with a newline
    total = lines.agg((F.count("*") + F.coalesce(closed, F.lit(1))).alias("n"), F.coalesce(closed, F.lit(1)).alias("closed"))
    tail = F.array(*[F.struct(F.lit(term).alias("term"), F.lit(nth).alias("nth")) for nth, term in enumerate(["", *VOCABULARY_TAIL], -1)])
    added = total.select("closed", "n", F.inline(tail)).filter("nth >= 0 or closed = 1")
    added = added.select("term", (F.col("n") + F.col("nth")).cast("int").alias("idx"))
    terms = lines.select(F.regexp_replace("piece", "\r$", "").alias("term"), "idx").unionByName(added)
    return terms.groupBy("term").agg(F.max("idx").alias("idx"))


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """(idx, weight, intercept) from a `{"weights": [...], "intercept": x}` file."""
    return (
        spark.read.schema(MODEL)
        .json(path, multiLine=True)
        .select(F.posexplode("weights").alias("idx", "weight"), "intercept")
    )


def read_message_array(spark: SparkSession, path: str) -> DataFrame:
    """Messages from files that hold one JSON array each. A file is read by one task."""
    return spark.read.schema(MESSAGE).json(path, multiLine=True)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets: int | None = 1_000_000,
) -> DataFrame:
    """Stream of (payload, arrived_at, source) from a Kafka topic. Needs Spark's Kafka connector package.

    A micro-batch takes max_offsets records at most, so that a backlog is worked off in pieces.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return topic_payloads(reader.load())


def topic_payloads(records: DataFrame) -> DataFrame:
    """Keep the value, the arrival time and the place in the topic of topic records."""
    return records.select(
        payload_text(F.col("value")).alias("payload"),
        F.col("timestamp").alias("arrived_at"),
        source(F.col("topic"), F.col("partition"), F.col("offset")),
    )


def source(stream: Column, part: Column | None = None, offset: Column | None = None) -> Column:
    """Where a payload comes from: a record of a topic's partition, or a file, which is read as a whole."""
    none = F.lit(0)
    return F.struct(
        stream.cast("string").alias("stream"),
        (none if part is None else part).cast("int").alias("part"),
        (none if offset is None else offset).cast("bigint").alias("offset"),
    ).alias("source")


def read_message_files(
    spark: SparkSession, path: str, max_files: int | None = 1_000
) -> DataFrame:
    """Stream of (payload, arrived_at, source) from JSON line files, one message per line, max_files at a time.

    The arrival time of a file source is the file's modification time.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        source(F.col("_metadata.file_path")),
    )


def newest_rows(history: DataFrame, n: int, ts: str | Column = "batch_ts") -> DataFrame:
    """The n newest rows of a serving table with one row per batch: a top-n, no full sort."""
    return history.orderBy(F.desc(ts) if isinstance(ts, str) else ts.desc()).limit(n)
