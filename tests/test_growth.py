"""How work is dealt out: few batches a task, hot batches split, words read no more often than needed."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moodstream.operators.heavy import heavy_words
from moodstream.operators.words import by_batch, count_words, explode_words
from moodstream.plans.words import all_counts
from moodstream.streaming import jobs


def tasks_by_batch(frame):
    found = frame.select("batch_ts", F.spark_partition_id().alias("task"), F.length("text").alias("n")).distinct().collect()
    return Counter(x.batch_ts for x in found)


def test_a_batch_stays_in_one_task(spark):
    frame = spark.range(4000, numPartitions=16).select((F.col("id") % 40).alias("batch_ts"), F.lit("a b").alias("text"))
    assert set(tasks_by_batch(frame).values()) == {16}
    assert set(tasks_by_batch(by_batch(frame)).values()) == {1}


def test_a_hot_batch_is_split(spark):
    text = F.concat(*(F.sha2(F.concat("id", F.lit(k)), 256) for k in map(str, range(8))))
    frame = spark.range(8000, numPartitions=16).select(F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(99).alias("batch_ts"), text.alias("text"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        dealt = by_batch(frame)
        assert tasks_by_batch(dealt)[99] > 1
        words = count_words(explode_words(dealt, ["batch_ts"]), ["batch_ts"])  # and is added up again
        assert {x.batch_ts: x.n for x in words.groupBy("batch_ts").agg(F.sum("cnt").alias("n")).collect()}[99] == 8000 - 2667
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("made", ["all_counts", "windowed_words"])
def test_words_are_counted_at_their_batch(spark, data, made):
    if made == "all_counts":
        frame = all_counts(spark, data)
    else:
        rows = [(datetime(2024, 1, 1, 0, k), "A b a") for k in range(3)]
        frame = jobs.windowed_words(spark.createDataFrame(rows, "event_ts timestamp, text string"), "1 minute")
        assert sorted((x.word, x.cnt) for x in frame.collect()) == [("a", 2)] * 3 + [("b", 1)] * 3
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RebalancePartitions")  # the plan has inputs below


def test_heavy_words_reads_the_words_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kind = "batch_ts bigint, word string, cnt bigint"
    rows = spark.range(600, numPartitions=3).selectExpr("id % 3 AS batch_ts", "'w' || (id % 7) AS word", "1L AS cnt").mapInArrow(count, kind)
    got = heavy_words(rows, 10).collect()
    assert len(got) == 21 and sum(x.cnt for x in got) == 600
    assert seen.value <= 2 * 600
