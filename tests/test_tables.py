"""Serving tables: commits, repeated input, compaction and what readers open."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodstream.operators.model import LinearModel
from moodstream.streaming import log as logs
from moodstream.streaming import tables as serving
from moodstream.streaming.jobs import window_outputs
from moodstream.streaming.log import Conflict, Log, Part, newest_cut
from moodstream.streaming.tables import (
    ServingTables,
    add_batch,
    compact,
    read_latest,
    read_parts,
    read_recent_text,
    read_sentiment,
    read_words,
    vacuum,
)

MODEL = LinearModel({"good": 1.0})
START = datetime(2024, 1, 1)
HOURLY = window_outputs(MODEL, "1 hour")
ROW = (
    "id long, event_ts timestamp, arrived_at timestamp, created_at string, author string, text string, "
    "source struct<stream: string, part: int, offset: long>"
)


def messages(spark, offsets, minutes=1, part=0):
    """Message k says `good wK` at minute k * minutes and lies at offset k."""
    rows = []
    for k in offsets:
        at = START + timedelta(minutes=k * minutes)
        rows.append((k, at, at, str(at), "u", f"good w{k % 7}", ("topic", part, k)))
    return spark.createDataFrame(rows, ROW)


def total(spark, tables):
    """Messages in the history, and the same by word."""
    history = read_sentiment(spark, tables).agg(F.sum("positive") + F.sum("negative")).first()[0]
    return history, read_words(spark, tables, top=1000).filter("word = 'good'").agg(F.sum("cnt")).first()[0]


def everything(spark, tables):
    return [sorted(x.collect()) for x in (read_sentiment(spark, tables), read_words(spark, tables), read_recent_text(spark, tables), read_latest(spark, tables))]


@pytest.fixture
def tables(tmp_path):
    return ServingTables(str(tmp_path / "tables"))


def test_input_read_again_counts_once(spark, tables):
    add = lambda run, epoch, offsets, part=0: add_batch(messages(spark, offsets, part=part), tables, run, epoch, HOURLY)
    assert add("a", 0, range(0, 30)) and add("a", 1, range(30, 60))
    assert not add("a", 1, range(30, 60))  # a retry of what is committed
    add("b", 0, range(0, 45))  # from the start, cut differently: the last 15 and the first 30 are covered
    add("b", 1, range(45, 75))
    add("c", 0, range(90, 100))  # from the latest
    add("c", 1, range(0, 5), part=1)  # another partition
    assert total(spark, tables) == (60 + 15 + 10 + 5, 60 + 15 + 10 + 5)
    ids = [x.id for x in read_recent_text(spark, tables, k=1000).collect()]
    assert all(ids.count(x) == 1 for x in ids if x >= 5)  # the other partition has ids below 5 again


def test_a_job_that_dies_between_writes_shows_nothing(spark, tables, monkeypatch):
    add_batch(messages(spark, range(10)), tables, "a", 0, HOURLY)
    before = everything(spark, tables)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(serving, "_snapshot", dies)  # all parts but the snapshot are written
        with pytest.raises(RuntimeError):
            add_batch(messages(spark, range(10, 30)), tables, "a", 1, HOURLY)
    with monkeypatch.context() as patch:
        patch.setattr(Log, "commit", dies)  # all are written
        with pytest.raises(RuntimeError):
            add_batch(messages(spark, range(10, 30)), tables, "a", 1, HOURLY)
    assert everything(spark, tables) == before
    add_batch(messages(spark, range(10, 30)), tables, "a", 1, HOURLY)
    assert total(spark, tables) == (30, 30)
    after = everything(spark, tables)
    assert vacuum(spark, tables) == 0  # too young
    assert vacuum(spark, tables, older_than=-60) >= 8  # two tries of four tables, and the old snapshot
    assert everything(spark, tables) == after


def test_two_writers(spark, tables):
    late = []

    def outputs(counted):
        """While the first run writes, a second one commits some of the same input."""
        if not late:
            late.append(add_batch(messages(spark, range(20)), tables, "second", 0, HOURLY))
        return HOURLY(counted)

    add_batch(messages(spark, range(30)), tables, "first", 0, outputs)
    assert late == [True] and total(spark, tables) == (30, 30)
    log = Log(spark, tables.folder)
    with pytest.raises(Conflict):
        log.commit(logs.State(), [])


def test_compaction_changes_nothing_but_the_parts(spark, tables):
    for epoch in range(6):
        add_batch(messages(spark, range(40 * epoch, 40 * epoch + 40)), tables, "a", epoch, HOURLY)
    before = everything(spark, tables)
    parts = len(Log(spark, tables.folder).state().parts)
    assert compact(spark, tables) > 0
    state = Log(spark, tables.folder).state()
    assert len(state.parts) < parts and everything(spark, tables) == before
    assert len(state.of("covered")) == len(state.of("latest")) == 1
    assert compact(spark, tables) == 0
    add_batch(messages(spark, [*range(5), *range(240, 250)], part=1), tables, "b", 0, HOURLY)  # late ones for a closed hour
    assert total(spark, tables) == (255, 255)
    late = everything(spark, tables)
    assert compact(spark, tables) > 0 and everything(spark, tables) == late
    add_batch(messages(spark, range(0, 240)), tables, "c", 0, HOURLY)  # covered, also by merged ranges
    assert total(spark, tables) == (255, 255)


def test_newest_reads_open_as_many_files_however_long_the_history(spark, tables):
    opened = []
    for days in (1, 3):
        for epoch in range(2):
            run = f"{days}-{epoch}"
            first = 24 * (days - 1) + 12 * epoch
            add_batch(messages(spark, range(first, first + 12), minutes=60), tables, run, 0, HOURLY)
        compact(spark, tables)
        state = Log(spark, tables.folder).state()
        opened.append(
            {name: len(read_parts(spark, tables, name, n).inputFiles()) for name, n in (("sentiment", 3), ("words", 2), ("latest", None))}
        )
        assert len(opened) == 1 or len(state.parts) > 60
        assert [x.batch_ts for x in read_sentiment(spark, tables, newest=3).orderBy("batch_ts").collect()] == [
            x.batch_ts for x in read_sentiment(spark, tables).orderBy(F.desc("batch_ts")).limit(3).collect()
        ][::-1]
    assert opened[0] == opened[1]


def test_log_goes_back_to_the_last_full_commit(spark, tables, monkeypatch):
    monkeypatch.setattr(logs, "FULL", 3)
    for epoch in range(5):
        add_batch(messages(spark, [epoch]), tables, "a", epoch, HOURLY)
    log = Log(spark, tables.folder)
    assert log.versions() == [0, 1, 2, 3, 4] and log.state().epochs == {"a": 4}
    before = everything(spark, tables)
    vacuum(spark, tables, older_than=-60)
    assert log.versions() == [3, 4] and everything(spark, tables) == before and total(spark, tables) == (5, 5)


def test_newest_cut():
    part = lambda first, last, n: Part("t", f"{first}", first, last, n)
    parts = [part(0, 9, 5), part(10, 19, 4), part(15, 25, 6), part(20, 29, 3)]
    assert newest_cut(parts, 3) == 20  # the last part alone has three
    assert newest_cut(parts, 7) == 10  # 20-29 and 10-19 lie beside each other
    assert newest_cut(parts, 12) == 0
    assert newest_cut(parts, 13) is None and newest_cut([], 1) is None


def test_tables_without_commits_are_empty(spark, tables):
    assert everything(spark, tables) == [[], [], [], []]
    assert compact(spark, tables) == 0 and vacuum(spark, tables) == 0


def test_views_open_few_files_of_a_part_that_reaches_over_the_history(spark, tables, monkeypatch):
    """Micro-batches that each hold the whole history: the newest batches are in few files of each, and so is what `_snapshot` reads."""
    spark_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "20"}
    before = {k: spark.conf.get(k) for k in spark_conf}
    opened, read = [], serving._read

    def reads(spark, tables, name, parts):
        if name == "words":
            opened.append(parts)
        return read(spark, tables, name, parts)

    try:
        for k, v in spark_conf.items():
            spark.conf.set(k, v)
        monkeypatch.setattr(serving, "_read", reads)
        for run in range(3):
            add_batch(messages(spark, range(run, 2000, 3), minutes=6), tables, "a", run, HOURLY)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parts = Log(spark, tables.folder).state().of("words")
    assert len(parts) == 3 and all(x.batches == 200 and len(x.files) > 10 for x in parts)
    for part in parts:
        assert (min(x.first for x in part.pieces()), max(x.last for x in part.pieces())) == (part.first, part.last)
    assert all(len(x) <= 3 * 3 for x in opened)  # the snapshot after each micro-batch
    opened.clear()
    newest = sorted(read_words(spark, tables, newest=5).collect())
    assert len(opened[0]) < sum(len(x.files) for x in parts) / 3
    whole = sorted(read_words(spark, tables).collect())
    last = sorted({x.batch_ts for x in whole})[-5:]
    assert newest == [x for x in whole if x.batch_ts in last] and len({x.batch_ts for x in newest}) == 5
    count = {(x.batch_ts, x.word): x.cnt for x in whole}
    assert sum(v for (_, word), v in count.items() if word == "good") == 2000
