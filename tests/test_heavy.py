"""Summaries of frequent words against exact counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodstream.operators import heavy
from moodstream.operators.heavy import bounds, heavy_words, pruned, summaries


def rows_of(seed, n=4000):
    random.seed(seed)
    words = ["the"] * 30 + ["of"] * 12 + [f"w{k}" for k in range(200)]
    return [(k % 3, random.choice(words) if k % 5 else f"rare{k}", random.choice([1, 1, 1, 7])) for k in range(n)]


@pytest.mark.parametrize("size, tasks", [(5, 1), (20, 6), (1000, 4)])
def test_bounds_hold(spark, size, tasks):
    rows = rows_of(size)
    frame = spark.createDataFrame(rows, "batch_ts int, word string, cnt int").repartition(tasks)
    parts = summaries(frame, size).persist()
    exact, totals, whole = Counter(), Counter(), Counter()
    for batch, word, n in rows:
        exact[batch, word] += n
        totals[batch] += n
        whole[word] += n
    slack = {x.batch_ts: x.s for x in parts.groupBy("batch_ts").agg(F.sum("slack").alias("s")).collect()}
    found = {(x.batch_ts, x.word): (x.lower, x.upper) for x in bounds(parts, ["batch_ts"]).collect()}
    for key, n in exact.items():
        low, high = found.get(key, (0, slack[key[0]]))
        assert low <= n <= high
    assert all(slack[batch] <= n / (size + 1) for batch, n in totals.items())
    merged = {x.word: (x.lower, x.upper) for x in bounds(parts, []).collect()}  # all batches in one
    assert all(low <= whole[word] <= high for word, (low, high) in merged.items())
    parts.unpersist()


@pytest.mark.parametrize("parts_of", [3, 10, 100])
def test_heavy_words_are_exact(spark, monkeypatch, parts_of):
    monkeypatch.setattr(heavy, "HELD", 40)
    rows = rows_of(parts_of)
    frame = spark.createDataFrame(rows, "batch_ts int, word string, cnt int").repartition(5)
    exact, totals = Counter(), Counter()
    for batch, word, n in rows:
        exact[batch, word] += n
        totals[batch] += n
    got = {(x.batch_ts, x.word): x.cnt for x in heavy_words(frame, parts_of).collect()}
    assert got == {key: n for key, n in exact.items() if n * parts_of >= totals[key[0]]}


def test_pruning():
    assert pruned({"a": 5, "b": 3, "c": 3, "d": 1}, 2) == ({"a": 2}, 3)
    assert pruned({"a": 1}, 2) == ({"a": 1}, 0) and pruned({}, 1) == ({}, 0)


def test_no_words(spark):
    nothing = spark.createDataFrame([], "batch_ts timestamp, word string, cnt bigint")
    assert heavy_words(nothing, 10).collect() == []
