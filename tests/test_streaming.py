"""Stream jobs on message files: batches, retries, reruns and quarantine."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodstream.operators.model import LinearModel
from moodstream.operators.recent import recent_per_batch
from moodstream.sources.readers import newest_rows, read_message_files
from moodstream.streaming import jobs
from moodstream.streaming.folders import new_folder
from moodstream.streaming.sources import bad_payloads, good_messages
from moodstream.streaming.tables import (
    ServingTables,
    read_latest,
    read_recent_text,
    read_sentiment,
    read_words,
)

MODEL = LinearModel({"good": 1.0, "bad": -1.0})
START = datetime(2024, 1, 1)


def line(i, text, second, lang="en"):
    time = (START + timedelta(seconds=second)).strftime("%a %b %d %H:%M:%S +0000 %Y")
    return json.dumps(
        {"id": i, "created_at": time, "text": text, "lang": lang, "user": {"screen_name": f"u{i}"}}
    )


FIRST = [line(1, "good good", 0), line(2, "bad", 1), line(3, "gut", 2, "de"), "junk",
         line(4, "", 2), line(5, "good", 61), line(6, "bad day", 62)]
SECOND = [line(7, "good", 63), line(8, "day", 130), line(9, "late", 400)]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(FIRST))
    return folder


def run(spark, inbox, tables, **options):
    messages = good_messages(read_message_files(spark, str(inbox), max_files=1))
    jobs.await_all(
        jobs.start_windows(
            messages, MODEL, tables, "1 minute", every=None, **options
        )
    )


def minute(ts):
    return int((ts - START).total_seconds() // 60)


def test_windows(spark, inbox, tmp_path):
    tables = ServingTables(str(tmp_path / "tables"))
    run(spark, inbox, tables)
    (inbox / "b.json").write_text("\n".join(SECOND))
    run(spark, inbox, tables)  # goes on from the checkpoint
    history = {
        minute(r.batch_ts): (r.negative, r.positive) for r in read_sentiment(spark, tables).collect()
    }
    # Minutes without messages have no row.
    assert history == {0: (1, 1), 1: (1, 2), 2: (1, 0), 6: (1, 0)}
    counts = {(minute(r.batch_ts), r.word): r.cnt for r in read_words(spark, tables).collect()}
    assert counts == {
        (0, "good"): 2, (0, "bad"): 1, (1, "good"): 2, (1, "bad"): 1, (1, "day"): 1, (2, "day"): 1,
        (6, "late"): 1,
    }
    assert [(minute(r.batch_ts), r.word) for r in read_latest(spark, tables).collect()] == [
        (6, "late")
    ]
    texts = {
        (minute(r.batch_ts), r.id) for r in read_recent_text(spark, tables, k=2).collect()
    }
    assert texts == {(0, 1), (0, 2), (1, 6), (1, 7), (2, 8), (6, 9)}
    assert minute(newest_rows(read_sentiment(spark, tables), 1).first().batch_ts) == 6


def test_no_message_is_lost(spark, tmp_path):
    """Undated and late messages, null ids, equal messages, several micro-batches, and the hour that autumn repeats."""
    hour = datetime(2024, 10, 27, 0, 30)  # 02:30 in Paris, and again an hour later
    dated = lambda text, ts: json.dumps(
        {"created_at": ts and ts.strftime("%a %b %d %H:%M:%S +0000 %Y"), "text": text, "lang": "en", "user": {"screen_name": "u"}}
    )
    files = [
        [dated("good a", hour), dated("good a", hour), dated("bad b", hour + timedelta(hours=1))],
        [dated("good c", hour + timedelta(days=3)), dated("bad undated", None), dated("bad d", None)],
        [dated("good late", hour), dated("good late", hour)],
    ]
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for number, lines in enumerate(files):
        path = inbox / f"{number}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_730_400_000 + number, 1_730_400_000 + number))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        tables = ServingTables(str(tmp_path / "tables"))
        messages = good_messages(read_message_files(spark, str(inbox), max_files=1))
        for _ in range(2):  # the second finds nothing new
            jobs.await_all(jobs.start_windows(messages, MODEL, tables, "1 hour", every=None))
        micros = F.unix_micros("batch_ts").alias("m")
        history = {r.m: (r.negative, r.positive) for r in read_sentiment(spark, tables).select(micros, "negative", "positive").collect()}
        at = lambda days, hours: int((datetime(2024, 10, 27) + timedelta(days=days, hours=hours) - datetime(1970, 1, 1)).total_seconds() * 10**6)
        undated = 1_730_400_000 // 3600 * 3600 * 10**6  # the hour of the arrival
        assert history[at(0, 0)] == (0, 4) and history[at(0, 1)] == (1, 0) and history[at(3, 0)] == (0, 1)
        assert sum(n + p for n, p in history.values()) == 8
        assert history[undated] == (2, 0)
        assert read_recent_text(spark, tables, k=9).count() == 8
        words = {(r.m, r.word): r.cnt for r in read_words(spark, tables).select(micros, "word", "cnt").collect()}
        assert words[at(0, 0), "good"] == 4 and words[at(0, 1), "bad"] == 1
        assert {r.word for r in read_latest(spark, tables).collect()} == {"bad", "undated", "d"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rerun_after_lost_checkpoint_changes_nothing(spark, inbox, tmp_path):
    (inbox / "b.json").write_text("\n".join(SECOND))
    tables = ServingTables(str(tmp_path / "tables"))
    run(spark, inbox, tables, run="one")

    def contents():
        return (
            sorted(read_sentiment(spark, tables).collect()),
            sorted(read_words(spark, tables).collect()),
            sorted(r.id for r in read_recent_text(spark, tables).collect()),
        )

    before = contents()

    class Moved(ServingTables):
        def checkpoint(self, output):
            return f"{self.folder}/other/{output}"

    run(spark, inbox, Moved(tables.folder), run="two")
    assert contents() == before


def test_retried_micro_batch_is_written_once(spark, inbox, tmp_path):
    tables = ServingTables(str(tmp_path / "tables"))
    lines = spark.read.text(str(inbox)).select(
        F.col("value").alias("payload"), F.lit(START).alias("arrived_at")
    )
    write = jobs.write_micro_batch(MODEL, tables, "run", show=True)
    messages = good_messages(lines)
    write(messages, 0)
    write(messages, 0)
    assert read_sentiment(spark, tables).select("negative", "positive").collect() == [(2, 2)]
    write(messages, 1)
    assert read_sentiment(spark, tables).count() == 2
    write(messages.limit(0), 2)  # an empty batch leaves no trace
    assert read_sentiment(spark, tables).count() == 2


def test_micro_batches(spark, inbox, tmp_path):
    (inbox / "b.json").write_text("\n".join(SECOND))
    tables = ServingTables(str(tmp_path / "tables"))
    for name in ("a.json", "b.json"):  # both files arrive in the same instant
        os.utime(inbox / name, (1_700_000_000, 1_700_000_000))
    messages = good_messages(read_message_files(spark, str(inbox), max_files=1))
    jobs.await_all([jobs.start_micro_batches(messages, MODEL, tables, every=None)])
    rows = read_sentiment(spark, tables).collect()
    assert sorted((r.negative, r.positive) for r in rows) == [(2, 1), (2, 2)]
    texts = read_recent_text(spark, tables)
    assert sorted(r.id for r in texts.collect()) == [1, 2, 5, 6, 7, 8, 9]
    words = read_words(spark, tables).groupBy("word").agg(F.sum("cnt").alias("n")).collect()
    assert {r.word: r.n for r in words} == {"good": 4, "bad": 2, "day": 2, "late": 1}


def test_quarantine_and_console(spark, inbox, tmp_path):
    tables = ServingTables(str(tmp_path / "tables"))
    payloads = read_message_files(spark, str(inbox))
    jobs.await_all([jobs.start_quarantine(bad_payloads(payloads), tables, every=None)])
    assert [r.payload for r in spark.read.parquet(tables.quarantine).collect()] == ["junk"]
    query = jobs.start_console(good_messages(payloads).select("id"), every=None)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_and_table_plans_agree(spark, inbox):
    lines = spark.read.text(str(inbox)).select(
        F.col("value").alias("payload"), F.lit(START).alias("arrived_at")
    )
    messages = good_messages(lines)
    words = jobs.windowed_words(messages, "1 minute").collect()
    assert sum(r.cnt for r in words) == 6
    history = jobs.windowed_sentiment(messages, MODEL, "1 minute").collect()
    assert sorted((r.negative, r.positive) for r in history) == [(1, 1), (1, 1)]
    batched = messages.withColumn("batch_ts", F.date_trunc("minute", "event_ts"))
    assert recent_per_batch(batched, 1).count() == 2


def test_arrival_time_as_clock(spark, inbox):
    lines = spark.read.text(str(inbox)).select(
        F.col("value").alias("payload"), F.lit(START).alias("arrived_at")
    )
    assert good_messages(lines, time="arrived_at").select("event_ts").distinct().collect() == [
        (START,)
    ]


def test_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = new_folder(spark, "x")
    assert folder != new_folder(spark, "x")
    if named is not None:
        assert folder.startswith(named.rstrip("/"))
