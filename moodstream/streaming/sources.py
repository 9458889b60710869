"""From topic payloads to messages with an event time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.operators.filters import keep_messages
from moodstream.sources.payload import decode_payload, literal_to_json, parse_created_at, split_bad


def decoded(payloads: DataFrame, literal: bool = False) -> DataFrame:
    """Payloads parsed and flagged; `literal` accepts payloads written as Python literals."""
    if literal:
        payloads = payloads.withColumn("payload", literal_to_json("payload"))
    return decode_payload(payloads)


def good_messages(
    payloads: DataFrame, time: str = "created_at", lang: str = "en", literal: bool = False
) -> DataFrame:
    """(id, event_ts, arrived_at, created_at, author, text) of non-empty messages in one language, and their `source` if payloads have one.

    `time` says which clock makes the batches: "created_at" of the message, or "arrived_at", which also stands in for
    a missing or unreadable "created_at".
    """
    good, _ = split_bad(decoded(payloads, literal))
    if time == "created_at":
        event_ts = F.coalesce(parse_created_at(F.col("created_at")), F.col("arrived_at"))
    else:
        event_ts = F.col(time)
    source = ["source"] if "source" in payloads.columns else []
    return keep_messages(good, lang).select(
        *source,
        "id",
        event_ts.alias("event_ts"),
        "arrived_at",
        "created_at",
        F.col("user.screen_name").alias("author"),
        "text",
    )


def bad_payloads(payloads: DataFrame, literal: bool = False) -> DataFrame:
    """Payloads for the quarantine output."""
    return split_bad(decoded(payloads, literal))[1]


def delivered_once(messages: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream of messages without repeated deliveries: of those with the same id that arrive `within` that time, the first.

    Ids are state until the newest arrival is that much later. A message without id has nothing to be known by, so it is kept.
    """
    known = F.coalesce(F.col("id").cast("string"), F.uuid())
    watched = messages.withColumn("_delivery", known).withWatermark("arrived_at", within)
    return watched.dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery")
