"""JSON arrays of any size, read by many tasks.

A file that is one JSON array has no line to cut it at, and a brace may as well stand inside a text. So the file is read in fragments that end at
closing braces, which Spark's text reader makes for every byte range by itself, and each fragment is summed up: whether it turns inside of quotes into
outside, and how many braces it opens if it begins outside or inside. Running sums over the fragments, within each byte range and
over the totals of the ranges, say where each fragment really begins, and so which braces count and where a record of the array ends. The
fragments of a record are then put together again, in their order, and parsed.

No task sees more than a byte range and the records that begin in it. In valid JSON no escape sign stands right before a closing brace, so a fragment never ends
in the middle of an escape.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.schemas import MESSAGE
from moodstream.sources.payload import decode_payload
from moodstream.sources.ranges import pieces, running

END = "}"


def _summed(piece: Column) -> list[Column]:
    """turns: 1 if the fragment holds an odd number of quotes; opens_out, opens_in: braces it opens if it begins outside or inside of a text."""
    plain = F.regexp_replace(piece, r"(?s)\\.", "")  # an escape and what it escapes
    parts = F.split(plain, '"', -1)
    braces = lambda odd: F.aggregate(
        F.transform(parts, lambda x, i: F.when(i % 2 == odd, F.regexp_count(x, F.lit(r"\{"))).otherwise(0)), F.lit(0), lambda a, x: a + x
    )
    return [((F.size(parts) - 1) % 2).alias("turns"), braces(0).alias("opens_out"), braces(1).alias("opens_in")]


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, payload): the objects of files that hold one JSON array each, as JSON texts."""
    rows = pieces(spark, path, END)
    rows = rows.select("file", "block", "at", "piece", *_summed(F.col("piece")))
    rows = running(rows, "turns", "quotes")
    inside = F.col("quotes") % 2 == 1
    ends_outside = (F.col("quotes") + F.col("turns")) % 2 == 0
    opens = F.when(inside, F.col("opens_in")).otherwise(F.col("opens_out"))
    rows = rows.withColumns({"opens": opens, "change": opens - F.when(ends_outside, 1).otherwise(0)})
    rows = running(rows, "change", "depth")
    last = ends_outside & (F.col("depth") + F.col("change") == 0)
    rows = rows.filter((F.col("depth") > 0) | (F.col("opens") > 0)).withColumn("ends", last.cast("int"))
    rows = running(rows, "ends", "record")
    in_order = F.array_sort(F.collect_list(F.struct("block", "at", "piece")))
    whole = rows.groupBy("file", "record").agg(in_order.alias("pieces"))
    text = F.concat(F.array_join(F.transform("pieces", lambda x: x["piece"]), END), F.lit(END))
    # What stands between records: the bracket of the array and commas.
    return whole.select("file", F.regexp_replace(text, r"^[^{]*", "").alias("payload"))


def read_arrays(spark: SparkSession, path: str, schema: T.StructType = MESSAGE) -> DataFrame:
    """Messages of JSON array files with `is_bad`, as `decode_payload` gives them for lines."""
    return decode_payload(array_records(spark, path).select("payload"), schema=schema)


def write_arrays(frame: DataFrame, path: str) -> None:
    """Write rows as JSON objects, an array per task."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = "["
        for batch in batches:
            rows = []
            for row in batch.column(0):
                rows.append(f"{sign}{row.as_py()}")
                sign = ","
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if sign == "[" else "]"])], ["value"])

    objects = frame.select(F.to_json(F.struct(*frame.columns)).alias("value"))
    objects.mapInArrow(lines, "value string").write.text(path)
