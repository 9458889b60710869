"""Windows written once: closed like by a watermark, with parts in place of a state."""

import json
import os
from collections import Counter
from datetime import datetime, timedelta

import pytest

from moodstream.sources.readers import read_message_files
from moodstream.streaming import jobs
from moodstream.streaming.log import Log
from moodstream.streaming.sources import good_messages
from moodstream.streaming.tables import ServingTables, compact, micros, read_latest, read_parts, read_words

START = datetime(2024, 1, 1)
#: Minutes and texts by micro-batch. The delay is 5 minutes, so the newest event at 8:00 closes all that ends by minute 3.
FILES = [
    [(0, "a a"), (1, "b"), (2, "c")],
    [(0, "a late"), (7.99, "d")],  # minutes 0 and 1 are closed with this, by the event at 7:59
    [(1, "dropped"), (2, "c in time"), (8, "e")],  # minute 2 ends at 3:00 and is closed now
    [(2, "dropped"), (20, "f")],
]


def line(minute, text):
    time = (START + timedelta(minutes=minute)).strftime("%a %b %d %H:%M:%S +0000 %Y")
    return json.dumps({"id": 1, "created_at": time, "text": text, "lang": "en", "user": {"screen_name": "u"}})


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    for number, rows in enumerate(FILES):
        path = folder / f"{number}.json"
        path.write_text("\n".join(line(*x) for x in rows))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    return folder


def counts(spark, tables):
    return Counter({(int((r.batch_ts - START).total_seconds() // 60), r.word): r.cnt for r in read_words(spark, tables).collect()})


CLOSED = {(0, "a"): 3, (0, "late"): 1, (1, "b"): 1, (2, "c"): 2, (2, "in"): 1, (2, "time"): 1, (7, "d"): 1, (8, "e"): 1}


@pytest.mark.parametrize("compacted", [False, True])
def test_windows_are_written_once_and_without_state(spark, inbox, tmp_path, compacted):
    tables = ServingTables(str(tmp_path / "tables"))
    messages = good_messages(read_message_files(spark, str(inbox), max_files=1))
    started = lambda: jobs.await_all([jobs.start_final_words(messages, tables, "1 minute", "5 minutes", every=None)])
    started()
    if compacted:
        compact(spark, tables, period=60)
    assert counts(spark, tables) == CLOSED
    assert [(r.word, r.cnt) for r in read_latest(spark, tables).collect()] == [("e", 1)]
    state = Log(spark, tables.folder).state()
    assert [x.batches for x in state.of("seen")] == [1]
    assert [r.word for r in read_parts(spark, tables, "open").collect()] == ["f"]  # the others are not needed any more
    assert not os.path.exists(f"{tables.checkpoint('final-words')}/state")
    path = inbox / "9.json"
    path.write_text("\n".join([line(8, "dropped"), line(20, "f"), line(60, "g")]))
    started()  # goes on where it was
    assert counts(spark, tables) == CLOSED | {(20, "f"): 2}


def test_messages_before_any_window_closes(spark, tmp_path):
    tables = ServingTables(str(tmp_path / "tables"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(line(0, "a"))
    messages = good_messages(read_message_files(spark, str(tmp_path / "in")))
    jobs.await_all([jobs.start_final_words(messages, tables, "1 minute", "15 days", every=None)])
    assert counts(spark, tables) == {} and read_parts(spark, tables, "open").count() == 1


def test_intervals(spark):
    assert [micros(spark, x) for x in ("1 hour", "15 days", "1 second 500 milliseconds")] == [3_600_000_000, 15 * 86_400_000_000, 1_500_000]
