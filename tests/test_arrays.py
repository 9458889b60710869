"""JSON arrays read by many tasks."""

import json
import random

import pytest

from moodstream.sources.arrays import array_records, read_arrays, write_arrays

HARD = [
    {"id": 1, "text": "a } b { c", "lang": "en"},
    {"id": 2, "text": 'quote " and \\ and \\" } end\\', "lang": "en", "user": {"screen_name": "x}{"}},
    {"id": 3, "text": "", "more": [{"a": {"b": {}}}, {"c": "}\"{"}], "lang": None},
    {},
    {"id": 4, "text": "é日本🙂 }\n{ ,] [", "lang": "fr", "user": {"screen_name": None}},
]


@pytest.fixture
def tiny_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1"}
    old = {x: spark.conf.get(x) for x in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_records_survive_any_cut(spark, tmp_path, tiny_ranges, layout):
    random.seed(4)
    files = [HARD * 4, [], random.sample(HARD * 3, 15), HARD[:1]]
    for number, rows in enumerate(files):
        (tmp_path / f"{number}.json").write_text(json.dumps(rows, **layout) + "\n", encoding="utf-8")
    found = array_records(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 9
    got = {}
    for row in found.collect():
        got.setdefault(row.file.rsplit("/", 1)[1][0], []).append(json.loads(row.payload))
    text = lambda rows: sorted(json.dumps(x, sort_keys=True) for x in rows)
    assert {k: text(v) for k, v in got.items()} == {str(k): text(rows) for k, rows in enumerate(files) if rows}


def test_messages_of_arrays(spark, tmp_path, tiny_ranges):
    path = tmp_path / "messages.json"
    path.write_text(json.dumps(HARD))
    rows = {x.id: x for x in read_arrays(spark, str(path)).collect()}
    assert rows[2].text == HARD[1]["text"] and rows[2].user.screen_name == "x}{" and rows[4].text == HARD[4]["text"]
    assert not any(x.is_bad for x in rows.values()) and rows[None].text is None


def test_a_file_without_an_array_has_no_records(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text("")
    assert array_records(spark, str(tmp_path)).collect() == []


def test_arrays_are_written_and_read(spark, tmp_path, tiny_ranges):
    frame = spark.createDataFrame([(k, "{" * k + '"') for k in range(20)], "id long, text string")
    write_arrays(frame.repartition(3), str(tmp_path / "some"))
    write_arrays(frame.limit(0), str(tmp_path / "none"))
    assert sorted(x.text for x in read_arrays(spark, str(tmp_path / "some")).collect()) == sorted(x.text for x in frame.collect())
    assert read_arrays(spark, str(tmp_path / "none")).collect() == []
