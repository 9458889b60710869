"""The messages of a stream are dealt out evenly, whatever files the events come in."""

import os

from pyspark.sql import functions as F

from moodstream.plans.streams import delivery, payload_stream
from moodstream.streaming import jobs


def test_a_streams_messages_are_dealt_out(spark, tmp_path):
    """One small file of events gives messages in all tasks, and a delivery is one file of more than one row group."""
    events = spark.range(4000, numPartitions=1).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + F.col("id")).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id")
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    documents = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "'some text ' || id AS text", "'en' AS lang")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    seen = []

    def write(frame, epoch):
        tasks = frame.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
        seen.append(sorted(x.n for x in tasks))

    stream = payload_stream(spark, str(tmp_path)).writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "kept"))
    jobs.await_all([stream.trigger(availableNow=True).start()])
    cores = spark.sparkContext.defaultParallelism
    assert [sum(x) for x in seen] == [4000]
    assert cores < len(seen[0]) <= 2 * cores and seen[0][-1] <= 4000 // cores
    delivery(spark, str(tmp_path), str(tmp_path / "deliveries"), 0)
    assert len([x for x in os.listdir(tmp_path / "deliveries") if x.endswith(".parquet")]) == 1
    assert spark.read.parquet(str(tmp_path / "deliveries")).count() == 4000 - 400
