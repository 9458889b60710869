"""Row types of the inputs and of the serving tables."""

from pyspark.sql import types as T

# One message as it travels on the topic. Fields beyond these are ignored.
MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
    ]
)

LABELLED = T.StructType(
    [T.StructField("sentiment", T.IntegerType()), T.StructField("text", T.StringType())]
)

MODEL = T.StructType(
    [
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
    ]
)

# Serving tables. A batch is a time window (or one micro-batch) that held at least one message.
SENTIMENT_HISTORY = T.StructType(
    [
        T.StructField("batch_ts", T.TimestampType()),
        T.StructField("negative", T.LongType()),
        T.StructField("positive", T.LongType()),
    ]
)

RECENT_TEXT = T.StructType(
    [
        T.StructField("batch_ts", T.TimestampType()),
        T.StructField("id", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

WORD_COUNTS = T.StructType(
    [
        T.StructField("batch_ts", T.TimestampType()),
        T.StructField("word", T.StringType()),
        T.StructField("cnt", T.LongType()),
    ]
)

# The newest event time that a job has met.
SEEN = T.StructType([T.StructField("batch_ts", T.TimestampType())])

# Input that a run has committed: offsets of one partition of a topic, or a file (part and offsets 0).
COVERED = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)
