"""Ids and numbers leave a task in parts of few bytes, and words are folded in tasks of many."""

import re

import public_tokenizers
import pytest
from pyspark.sql import DataFrameWriter

from moodstream.llm import bpe
from moodstream.llm.bpe_query import RANKS, digests


@pytest.fixture
def short(edge):
    """Buckets grow with the texts and shrink with the block, so blocks of some hundred characters need short texts."""
    return edge.filter("text IS NULL OR length(text) < 1000")


def digested(frame):
    return sorted(digests(frame).collect(), key=str)


def test_parts_change_nothing(short, monkeypatch):
    whole = digested(short)
    monkeypatch.setattr(bpe, "SENT", 64)  # some rows a part, and some parts a block
    assert digested(short) == whole and len(whole) == short.count()
    monkeypatch.setattr(bpe, "BLOCK", 200)  # blocks end within parts and with them
    assert digested(short) == whole


def test_ids_as_arrays_in_parts(edge, monkeypatch):
    tokens = bpe.tokenizer(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    ids = lambda: sorted(((x.doc_id, x.ids) for x in bpe.with_ids(edge, tokens).collect()), key=str)
    whole = ids()
    monkeypatch.setattr(bpe, "SENT", 64)
    assert ids() == whole


def test_words_are_folded_in_few_tasks(spark, short, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 256)  # many buckets
    plan = digests(short)._jdf.queryExecution().optimizedPlan().toString()
    assert [int(x) for x in re.findall(r"RepartitionByExpression \[word#\d+\], (\d+)", plan)] == [spark.sparkContext.defaultParallelism]


def test_texts_go_to_the_cut_in_short_batches(spark, short, monkeypatch):
    """Also where the session asks for longer ones, which it has again afterwards."""
    name, seen, save = "spark.sql.execution.arrow.maxRecordsPerBatch", [], DataFrameWriter.saveAsTable

    def saved(writer, *given, **named):
        seen.append(int(spark.conf.get(name)))
        return save(writer, *given, **named)

    whole, before = digested(short), spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", saved)
    assert digested(short) == whole and seen == [min(int(before), bpe.ROWS)] and bpe.ROWS < 10_000
    monkeypatch.setattr(bpe, "ROWS", 3)
    assert digested(short) == whole and seen[1:] == [3] and spark.conf.get(name) == before
