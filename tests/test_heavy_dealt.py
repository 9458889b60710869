"""Heavy words: texts are dealt out by batch only where a task can't hold the summaries of all batches."""

import pytest

from moodstream.operators import heavy
from moodstream.plans import words


def test_texts_of_few_batches_stay_with_their_documents(spark, data, monkeypatch):
    dealt, by_batch = [], words.by_batch
    monkeypatch.setattr(words, "by_batch", lambda frame: dealt.append(frame) or by_batch(frame))
    near = sorted(words.heavy_words_by_window(spark, data).collect())
    assert near and not dealt
    monkeypatch.setattr(heavy, "HELD", 100)
    assert sorted(words.heavy_words_by_window(spark, data).collect()) == near and len(dealt) == 1


@pytest.mark.parametrize("batches, fits", [(0, True), (1310, True), (1311, False)])
def test_what_a_task_can_hold(batches, fits):
    assert heavy.holds(batches, 50) == fits
