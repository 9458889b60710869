"""Relations between queries, and queries on skewed tables."""

import duckdb
import pytest
from oracle import compare, database
from pyspark.sql import functions as F

from moodstream.plans.catalogue import QUERIES


def test_top_words_are_among_all_words(spark, data):
    top = QUERIES["word_count_topk"](spark, data)
    assert top.exceptAll(QUERIES["word_count_by_window"](spark, data)).isEmpty()
    assert top.groupBy("batch_ts").count().agg(F.max("count")).first()[0] <= 100


def test_volume_is_the_sum_of_both_classes(spark, data):
    history = QUERIES["sentiment_history_all"](spark, data)
    assert history.filter("volume != positive + negative or volume <= 0").isEmpty()
    predicted = QUERIES["sentiment_by_window"](spark, data).agg(F.sum("cnt")).first()[0]
    assert history.agg(F.sum("volume")).first()[0] == predicted


def test_confusion_cells_sum_to_the_labelled_rows(spark, data):
    cells = QUERIES["confusion_matrix"](spark, data).agg(F.sum("cnt")).first()[0]
    assert cells == QUERIES["labelled_sample"](spark, data).count()


def test_shares_sum_to_one(spark, data):
    assert QUERIES["sentiment_pie"](spark, data).agg(F.sum("share")).first()[0] == pytest.approx(1)


@pytest.fixture(scope="module")
def skewed(data, tmp_path_factory):
    """One document carries a third of the events, one hour another third."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    con.execute(
        f"COPY (SELECT * FROM '{data}/documents.parquet') TO '{folder}/documents.parquet'"
    )
    total = con.execute(f"SELECT count(*) FROM '{data}/documents.parquet'").fetchone()[0]
    con.execute(
        f"""
        COPY (
          SELECT CASE WHEN i % 3 = 0 THEN i * {total} + 4 ELSE i * {total} + i % {total} END
                   AS event_id,
                 CASE WHEN i % 3 = 1 THEN TIMESTAMP '2024-01-10 05:00:00' + to_seconds(i % 3500)
                      ELSE TIMESTAMP '2024-01-01' + to_seconds(i * 700) END AS ts,
                 i % 50 AS user_id
          FROM range(6000) t(i)
        ) TO '{folder}/events.parquet'
        """
    )
    return folder, database(folder)


SKEWED = [
    "word_count_topk",
    "word_count_long",
    "sentiment_by_window",
    "sentiment_history_short",
    "recent_per_window",
    "recent_tweets",
    "trailing_volume",
]


@pytest.mark.parametrize("name", SKEWED)
def test_skewed_tables_with_shuffled_joins(spark, skewed, name):
    folder, con = skewed
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        ok, note = compare(spark, con, folder, name)
    finally:
        spark.conf.set(setting, before)
    assert ok, note
