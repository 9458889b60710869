"""Operators on hand-made rows."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodstream.operators import features, filters, model, ranking, recent, sentiment, words
from moodstream.operators.cloud import cloud
from moodstream.plans.messages import spread
from moodstream.sources import payload, readers
from moodstream.streaming.folders import written

T0 = datetime(2024, 1, 1)


def messages(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string, lang string")


def test_filters(spark):
    frame = messages(
        spark,
        [(1, "hi", "en"), (2, "", "en"), (3, None, "en"), (4, "hi", None), (5, "hi", "EN"),
         (6, "Big NEWS today", "en")],
    )
    assert [r.id for r in filters.keep_messages(frame).orderBy("id").collect()] == [1, 6]
    assert [r.id for r in filters.track(frame, "news,none").collect()] == [6]
    assert [r.id for r in filters.track(frame, " news ,,").collect()] == [6]
    with pytest.raises(ValueError, match="no subject"):
        filters.track(frame, " , ")
    assert [r.id for r in filters.track(frame, ["HI"]).orderBy("id").collect()] == [1, 4, 5]
    assert [r.id for r in filters.take_first(frame, 2, F.desc("id")).collect()] == [6, 5]
    filled = {r.id: (r.text, r.lang) for r in payload.with_defaults(frame).collect()}
    assert filled[3] == ("", "en") and filled[4] == ("hi", "")


def test_keyword_may_be_absent(spark):
    frame = spark.createDataFrame([("a", 1)], "word string, cnt bigint")
    assert filters.without_keyword(frame, "zz").count() == 1
    assert filters.without_keyword(frame, "a").count() == 0


def test_payloads(spark):
    good = {"id": 1, "created_at": "x", "text": "a \"q\" é", "lang": "en",
            "user": {"screen_name": "bob"}, "extra": [1]}
    rows = [json.dumps(good), "junk", '{"id": 2', None, "{}"]
    frame = spark.createDataFrame([(r,) for r in rows], "payload string")
    decoded = payload.decode_payload(frame)
    ok, bad = payload.split_bad(decoded)
    found = ok.collect()
    assert len(found) == 2 and found[0].user.screen_name == "bob" and found[0].text == 'a "q" é'
    assert sorted(r.payload or "" for r in bad.collect()) == ["", "junk", '{"id": 2']


def test_python_literal_payloads(spark):
    tweet = {"id": 3, "text": "it's \"x\"", "lang": "en", "user": {"screen_name": None}, "t": True}
    frame = spark.createDataFrame([(str(tweet),), ("junk(",), (None,)], "payload string")
    decoded = payload.decode_payload(
        frame.withColumn("payload", payload.literal_to_json("payload"))
    )
    rows = decoded.orderBy(F.desc_nulls_last("id")).collect()
    assert rows[0].text == "it's \"x\"" and not rows[0].is_bad
    assert [r.is_bad for r in rows[1:]] == [True, True]


def test_python_literals_of_any_kind(spark):
    random.seed(5)
    signs = ["'", '"', "\\", "\n", "\t", "\r", "\x01", "\x03", "\x7f", "é", "日", "🙂", "\U000e0001", "\ue000", "None", "True", "{", "}", ", ", ": ", "u", "x41", "U0001f600", " "]
    text = lambda: "".join(random.choices(signs, k=random.choice([0, 1, 3, 12])))
    value = lambda deep: random.choice([text, text, lambda: None, lambda: True, lambda: -1.5e3, lambda: [text() for _ in range(deep)], lambda: {text(): value(deep - 1)} if deep else 7])()
    rows = [{"id": k, "text": text(), "lang": text(), "user": {"screen_name": text()}, "more": value(2)} for k in range(300)]
    rows.append({"id": 300, "text": "\n'\"\\" * 20_000, "lang": None, "user": None})
    frame = spark.createDataFrame([(x["id"], str(x)) for x in rows], "key long, payload string")
    found = frame.select("key", payload.literal_to_json("payload").alias("json")).collect()
    assert {x.key: json.loads(x.json) for x in found} == {x["id"]: x for x in rows}
    decoded = payload.decode_payload(frame.withColumn("payload", payload.literal_to_json("payload")))
    assert {(x.id, x.text, x.lang) for x in decoded.collect()} == {(x["id"], x["text"], x["lang"]) for x in rows}
    bad = ["{'text': 'a}", "{'text': it's}", "{'id': 1, 'x': b'a'}", "{'id': 1, }x", "{'id': (1, 2)}", "", "{'id': 1, 'text': '\x01'}"]
    wrong = spark.createDataFrame([(x,) for x in bad], "payload string")
    assert all(x.is_bad for x in payload.decode_payload(wrong.withColumn("payload", payload.literal_to_json("payload"))).collect())


def test_created_at(spark):
    frame = spark.createDataFrame(
        [("Wed Oct 10 20:19:24 +0000 2018",), ("2024-01-01 00:00:07.5Z",), ("no",)], "c string"
    )
    got = [r[0] for r in frame.select(payload.parse_created_at(F.col("c"))).collect()]
    assert got[0] == datetime(2018, 10, 10, 20, 19, 24)
    assert got[1] == datetime(2024, 1, 1, 0, 0, 7, 500000)
    assert got[2] is None


def test_labelled_lines(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("sentiment,text\n1,a, b\n0,x\nnope,y\n1\n")
    good, bad = readers.split_bad_labels(readers.read_labelled(spark, str(path)))
    assert sorted((r.sentiment, r.text) for r in good.collect()) == [(0, "x"), (1, "a, b")]
    assert bad.count() == 2


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("the\nof\nI\n")
    found = {r.term: r.idx for r in readers.read_vocabulary(spark, str(path)).collect()}
    assert found == {
        "the": 0, "of": 1, "I": 2, "": 3, "pseudoplaceholder": 4, "linkplaceholder": 5,
        "retweetplaceholder": 6, "hashtagplaceholder": 7,
    }


@pytest.mark.parametrize("text", ["the\nof\nI\n", "the\r\nof\r\nthe", "", "\n", "a", "é\n日\n\na\na"])
def test_vocabulary_file_by_byte_ranges(spark, tmp_path, text):
    path = tmp_path / "words.txt"
    path.write_bytes(text.encode())
    terms = [*text.replace("\r\n", "\n").split("\n"), "pseudoplaceholder", "linkplaceholder", "retweetplaceholder", "hashtagplaceholder"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = {r.term: r.idx for r in readers.read_vocabulary(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert found == {term: k for k, term in enumerate(terms)}


def test_numbers_by_ranges(spark):
    rows = [((k * 0x9E3779B97F4A7C15) % 2**63 - 2**62, k % 3) for k in range(500)] + [(None, 1), (5, 1), (5, 1)]
    frame = spark.createDataFrame(rows, "id long, other long").repartition(6)
    found = ranking.numbered_by_ranges(frame, "id")
    ordered = sorted(found.collect(), key=lambda x: x.idx)
    assert [x.idx for x in ordered] == list(range(503))
    assert [x.id for x in ordered] == [None, *sorted(x for x, _ in rows if x is not None)]
    assert ranking.numbered_by_ranges(frame.limit(0), "id").collect() == []


def test_message_array(spark, tmp_path):
    path = tmp_path / "messages.json"
    path.write_text(json.dumps([{"id": 1, "text": "a"}, {"id": 2, "user": {"screen_name": "x"}}]))
    rows = readers.read_message_array(spark, str(path)).orderBy("id").collect()
    assert rows[0].text == "a" and rows[1].user.screen_name == "x"


def test_topic_records(spark):
    records = spark.createDataFrame(
        [(None, bytearray("é".encode()), "t", 0, 1, T0)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    assert readers.topic_payloads(records).first().payload == "é"


def test_word_counts(spark):
    frame = messages(spark, [(1, "A b a", "en"), (2, "!!", "en"), (3, "b", "en")])
    counts = words.count_words(words.explode_words(frame))
    assert {r.word: r.cnt for r in counts.collect()} == {"a": 2, "b": 2}
    weighed = words.count_words(words.explode_words(frame, ["id"]), copies="id")
    assert {r.word: r.cnt for r in weighed.collect()} == {"a": 2, "b": 4}


def history(spark, rows):
    return spark.createDataFrame(
        [(T0 + timedelta(hours=h), w, c) for h, w, c in rows],
        "batch_ts timestamp_ntz, word string, cnt bigint",
    )


def test_top_words_break_ties_by_word(spark):
    frame = history(spark, [(0, "c", 1), (0, "b", 1), (0, "a", 2), (1, "z", 1)])
    top = words.top_words(frame, 2).orderBy("batch_ts", "word").collect()
    assert [r.word for r in top] == ["a", "b", "z"]


def test_newest_batches_count_only_batches_with_rows(spark):
    frame = history(spark, [(0, "a", 1), (5, "a", 1), (5, "b", 1), (9, "a", 4)])
    assert words.newest_batches(frame, 2).count() == 3
    totals = {r.word: r.cnt for r in words.merge_counts(words.newest_batches(frame, 2)).collect()}
    assert totals == {"a": 5, "b": 1}


def test_wide_rows(spark):
    frame = history(spark, [(0, "a", 1), (0, "b", 2), (1, "a", 3)])
    wide = words.as_wide_rows(frame)
    assert {r.batch_ts.hour: r.cells for r in wide.collect()} == {
        0: {"word_count:a": "1", "word_count:b": "2"},
        1: {"word_count:a": "3"},
    }
    assert sorted(words.from_wide_rows(wide).collect()) == sorted(frame.collect())


@pytest.mark.parametrize("block", [1, 4, 7, 4096])
def test_numbered_and_trailing(spark, block):
    days = [T0 + timedelta(hours=7 * i) for i in range(50)]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(days)], "ts timestamp_ntz, v bigint")
    dense = ranking.numbered(frame, F.col("ts"), F.col("ts").cast("date"))
    rows = ranking.trailing_sum(dense, "idx", ["v"], 5, block).orderBy("ts").collect()
    assert [r.idx for r in rows] == list(range(50))
    assert [r.trailing_v for r in rows] == [sum(range(max(0, i - 4), i + 1)) for i in range(50)]


def test_top_per_group_limits_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 3 g", "id v")
    plan = ranking.top_per_group(frame, "g", [F.desc("v")], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_vocabulary(spark):
    counts = spark.createDataFrame(
        [("b", 5), ("a", 5), ("c", 9), ("d", 1), ("linkplaceholder", 50)], "word string, cnt bigint"
    )
    found = {r.term: r.idx for r in features.build_vocabulary(counts, 3).collect()}
    assert found == {
        "c": 0, "a": 1, "b": 2, "pseudoplaceholder": 3, "linkplaceholder": 4,
        "retweetplaceholder": 5, "hashtagplaceholder": 6,
    }
    short = {r.term: r.idx for r in features.build_vocabulary(counts, 99).collect()}
    assert short["hashtagplaceholder"] == 7
    assert features.checked_size(counts, 5) == 5 and features.checked_size(counts, 4) is None
    with pytest.raises(ValueError):
        features.vocabulary_terms(features.build_vocabulary(counts, 3), 6)


def test_term_frequency_forms_agree(spark):
    frame = messages(spark, [(1, "a b A @x", "en"), (2, "zzz", "en"), (3, "c c c", "en")])
    vocabulary = spark.createDataFrame(
        [("a", 0), ("b", 1), ("c", 2), ("pseudoplaceholder", 3)], "term string, idx bigint"
    )
    expected = {(1, 0, 2), (1, 1, 1), (1, 3, 1), (3, 2, 3)}
    for limit in (4, None):
        long = features.term_frequency(frame, vocabulary, max_terms=limit)
        assert {(r.id, r.idx, r.tf) for r in long.collect()} == expected
    terms = features.vocabulary_terms(vocabulary)
    points = features.labelled_points(frame, terms, F.lit(1)).collect()
    vectors = {
        (r.id, int(i), int(v))
        for r in points
        for i, v in zip(r.features.indices, r.features.values, strict=True)
    }
    assert vectors == expected and points[0].label == 1.0 and points[0].features.size == 4


def test_scoring(spark, tmp_path):
    frame = messages(
        spark, [(1, "good good bad", "en"), (2, "zzz", "en"), (3, "", "en"), (4, "bad", "en")]
    )
    (tmp_path / "words").write_text("good\nbad")
    (tmp_path / "model.json").write_text(
        json.dumps({"weights": [1.5, -1.0, 0, 0, 0, 0], "intercept": 0.25})
    )
    vocabulary = readers.read_vocabulary(spark, str(tmp_path / "words"))
    weights = readers.read_model(spark, str(tmp_path / "model.json"))
    loaded = model.load_linear_model(vocabulary, weights)
    assert loaded == model.LinearModel({"good": 1.5, "bad": -1.0}, 0.25)
    expected = {1: (2.25, 1), 2: (0.25, 1), 3: (0.25, 1), 4: (-0.75, 0)}
    direct = model.score_messages(frame, loaded)
    table = spark.createDataFrame(list(loaded.weights.items()), "term string, weight double")
    joined = model.score_by_join(frame, table, intercept=loaded.intercept)
    for scored in (direct, joined):
        assert {r.id: (r.margin, r.prediction) for r in scored.collect()} == expected
    # Without an intercept a message without known terms is negative.
    bare = model.score_messages(frame, model.LinearModel({"good": 1.0}))
    assert {r.id: r.prediction for r in bare.collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_history_views(spark):
    rows = [(T0, 0), (T0, 1), (T0, 1), (T0 + timedelta(hours=3), 0)]
    predictions = spark.createDataFrame(rows, "batch_ts timestamp_ntz, prediction int")
    table = sentiment.sentiment_history(predictions)
    recent_rows = sentiment.recent_history(table, 5).collect()
    assert [(r.negative, r.positive, r.volume, r.position) for r in recent_rows] == [
        (1, 2, 3, 1),
        (1, 0, 1, 2),
    ]
    frame = sentiment.recent_history(table, 5)
    bounds = sentiment.axis_bounds(frame).first()
    assert (bounds.min_volume, bounds.max_volume) == (1, 3)
    assert (bounds.min_sentiment, bounds.max_sentiment) == (0, 2)
    shares = {r.label: (r.cnt, r.share) for r in sentiment.class_shares(frame).collect()}
    assert shares == {"Positive": (2, 0.5), "Negative": (2, 0.5)}
    counted = sentiment.count_predictions(predictions)
    assert Counter({(r.batch_ts, r.prediction): r.cnt for r in counted.collect()}) == Counter(rows)


def test_cloud(spark):
    frame = spark.createDataFrame([("a", 10), ("b", 1), ("c", 5)], "word string, cnt bigint")
    plain = {r.word: r.font_size for r in cloud(frame).collect()}
    assert plain["b"] == pytest.approx((-1.0 * 0.4 + 1) * 120)
    assert plain["a"] == pytest.approx((0.8 * 0.4 + 1) * 120)
    assert [r.word for r in cloud(frame, "count", 2).collect()] == ["a", "c"]
    assert [r.word for r in cloud(frame, "count", 2, compat=True).collect()] == ["c", "b"]
    coloured = cloud(frame, "random", seed=1).collect()
    assert all(r.colour.startswith("#") and -1 <= r.score < 1 for r in coloured)
    again = cloud(frame.repartition(3), "random", seed=1).collect()
    assert {r.word: r.score for r in again} == {r.word: r.score for r in coloured}


def test_recent_table(spark):
    rows = [(i, T0 + timedelta(seconds=i // 2), "2024-01-01 00:00:00.123", "u", f"t{i}")
            for i in range(9)]
    frame = spark.createDataFrame(
        rows, "id bigint, event_ts timestamp, created_at string, author string, text string"
    )
    table = recent.as_table(frame, 3)
    assert table.columns == ["Time", "Tweet", "Author"]
    assert [r.Tweet for r in table.collect()] == ["t8", "t7", "t6"]
    assert table.first().Time == "2024-01-01 00:00:00"


def test_training(spark, tmp_path):
    rows = [(i, i % 2, "good day" if i % 2 else "bad day") for i in range(200)]
    frame = spark.createDataFrame(rows, "id bigint, sentiment int, text string")
    terms = ["good", "bad", "day"]
    points = features.labelled_points(frame, terms)
    train, test = model.split_by_key(points)
    assert train.count() + test.count() == 200 and 130 < train.count() < 190
    assert train.join(test, "id", "left_semi").count() == 0
    fitted = model.train_model(train)
    cells = {r.outcome: r.cnt for r in model.confusion(model.predict(fitted, test)).collect()}
    assert set(cells) == {"True Positive", "True Negative"} and sum(cells.values()) == test.count()
    model.export_model(spark, fitted, str(tmp_path / "model"))
    back = readers.read_model(spark, str(tmp_path / "model")).orderBy("idx").collect()
    assert [r.weight for r in back] == list(fitted.coefficients.toArray())
    # The exported weights give the predictions of the fitted model.
    vocabulary = spark.createDataFrame(list(zip(terms, range(3))), "term string, idx int")
    loaded = model.load_linear_model(vocabulary, readers.read_model(spark, str(tmp_path / "model")))
    scored = model.score_messages(frame, loaded)
    assert scored.filter("prediction != sentiment").count() == 0
    first, second = model.split_at_random(frame, seed=5)
    assert first.count() + second.count() == 200


def test_confusion_cells(spark):
    frame = spark.createDataFrame(
        [(1, 1.0), (1, 0.0), (0, 0.0), (0, 1.0), (0, 1.0)], "prediction int, label double"
    )
    assert {r.outcome: r.cnt for r in model.confusion(frame).collect()} == {
        "True Positive": 1, "False Positive": 1, "True Negative": 1, "False Negative": 2,
    }


def test_replay_draws_with_replacement(spark):
    corpus = spark.range(0, 400, 4).withColumn("text", F.col("id").cast("string"))
    numbers = ranking.numbered(corpus.select("id"), F.col("id"), F.floor(F.col("id") / 64))
    draws = model.draw_numbers(spark, 300)
    sample = model.replay(corpus, numbers, draws)
    rows = sample.collect()
    assert len(rows) == 300 and sorted(r.draw for r in rows) == list(range(300))
    assert 70 < len({r.id for r in rows}) < 100
    assert sorted(sample.collect()) == sorted(rows)


def test_spread_leaves_well_split_tables_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    for partitions, expected in ((1, cores), (cores, cores), (3 * cores, 3 * cores)):
        frame = spread(spark.range(0, 1000, 1, partitions))
        assert frame.rdd.getNumPartitions() == expected
        assert frame.count() == 1000
    plan = spread(spark.range(0, 1000, 1, cores))._jdf.queryExecution().toString()
    assert "Repartition" not in plan


def test_written_frame_is_read_back(spark):
    frame = spark.createDataFrame([(1, T0), (2, None)], "a bigint, t timestamp_ntz")
    back = written(frame, "test")
    assert back.schema == frame.schema and sorted(back.collect()) == sorted(frame.collect())


def test_mean_weight(spark):
    frame = messages(spark, [(1, "good x bad good", "en"), (2, "", "en")])
    scorer = model.LinearModel({"good": 1.0, "bad": -0.5}, 0.25)
    score = model.mean_weight(F.split(F.col("text"), " "), scorer)
    rows = {r.id: r.s for r in frame.select("id", score.alias("s")).collect()}
    assert rows == {1: 1.75 / 4, 2: 0.25}
