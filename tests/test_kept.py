"""What stream jobs keep while they write: texts only where an output needs them, each taken apart once, and nothing of the micro-batches before."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from moodstream.operators.model import LinearModel
from moodstream.streaming import folders, jobs
from moodstream.streaming import tables as serving
from moodstream.streaming.jobs import start_windows, window_outputs, windowed_sentiment, windowed_words
from moodstream.streaming.log import Log
from moodstream.streaming.sources import delivered_once
from moodstream.streaming.tables import ServingTables, add_batch, compact, read_sentiment

MODEL = LinearModel({"good": 1.0, "pseudoplaceholder": 2.0, "bad": -1.0})
ROW = (
    "id long, event_ts timestamp, arrived_at timestamp, created_at string, author string, text string, "
    "source struct<stream: string, part: int, offset: long>"
)
TEXTS = ["good day", "a bad day", "@you bad", "!!", "", None, "Good good -0 -1", "rt: #x"]


def messages(spark, offsets):
    rows = []
    for k in offsets:
        at = None if k % 11 == 10 else datetime(2024, 1, 1) + timedelta(minutes=k)
        rows.append((k, at, at, str(at), "u", TEXTS[k % len(TEXTS)], ("topic", 0, k)))
    return spark.createDataFrame(rows, ROW)


def test_words_and_classes_are_counted_together(spark):
    given = messages(spark, range(400))
    frames = window_outputs(MODEL, "1 hour")(given)
    assert len(frames.kept) == 1
    plan = frames.kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(lower(text") == 1
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    assert rows(frames["words"]) == rows(windowed_words(given, "1 hour")) != []
    assert rows(frames["sentiment"]) == rows(windowed_sentiment(given, MODEL, "1 hour")) != []
    for frame in frames.kept:
        frame.unpersist()


def test_sentiment_alone_keeps_no_text(spark):
    given = messages(spark, range(60))
    outputs = window_outputs(MODEL, "1 hour", ("sentiment",))
    narrow = outputs.narrowed(given)
    assert narrow.columns == ["source", "event_ts", "prediction"]
    assert sorted(outputs(narrow)["sentiment"].collect()) == sorted(windowed_sentiment(given, MODEL, "1 hour").collect())


def test_nothing_is_written_of_what_is_covered(spark, tmp_path):
    tables = ServingTables(str(tmp_path / "tables"))
    log, hourly = Log(spark, tables.folder), window_outputs(MODEL, "1 hour")
    assert add_batch(messages(spark, range(40)), tables, "a", 0, hourly)
    written, parts = log.modified("sentiment"), log.state().parts
    assert add_batch(messages(spark, range(30)), tables, "b", 0, hourly, streamed=True)
    assert log.state().parts == parts and log.modified("sentiment") == written and log.state().epochs == {"a": 0, "b": 0}
    assert not add_batch(messages(spark, []), tables, "b", 1, hourly, streamed=True) and log.state().epochs["b"] == 0


def test_compaction_sends_rows_once(spark):
    rows = spark.range(100).selectExpr("timestamp_seconds(id) AS batch_ts", "'w' AS word", "id AS cnt", "id % 5 AS period").repartition("period")
    for merged in (serving.MERGED["words"], serving.MERGED["open"]):
        assert merged(rows, "period")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_a_micro_batch_begins_with_a_clean_up(spark, tmp_path, monkeypatch):
    """So does a compaction; within a few seconds it is done once only."""
    done = []
    monkeypatch.setattr(folders.gc, "collect", lambda: done.append(1))
    monkeypatch.setitem(folders._cleaned, "at", float("-inf"))
    jobs.write_windows(MODEL, ServingTables(str(tmp_path)), "1 hour", "a")(messages(spark, []), 0)
    assert len(done) == 1
    compact(spark, ServingTables(str(tmp_path)))
    assert len(done) == 1
    monkeypatch.setitem(folders._cleaned, "at", float("-inf"))
    compact(spark, ServingTables(str(tmp_path)))
    assert len(done) == 2


def test_state_is_not_on_the_heap(spark, tmp_path):
    """Ids of deliveries are kept by RocksDB; the session's settings stay as they are."""
    path, tables = str(tmp_path / "deliveries"), ServingTables(str(tmp_path / "tables"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    messages(spark, [0, 1, 2, 3]).union(messages(spark, [2, 3, 4])).filter(F.col("arrived_at").isNotNull()).write.parquet(path)
    stream = spark.readStream.schema(ROW).parquet(path)
    [job] = start_windows(delivered_once(stream, "60 days"), MODEL, tables, "1 hour", None, outputs=("sentiment",))
    jobs.await_all([job])
    operators = [x for p in job.recentProgress for x in p.stateOperators]
    assert operators and all(any(k.startswith("rocksdb") for k in x.customMetrics) for x in operators)
    assert read_sentiment(spark, tables).agg(F.sum("positive") + F.sum("negative")).first()[0] == 5
    assert spark.conf.get(name) == before
