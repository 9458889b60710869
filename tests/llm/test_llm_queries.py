"""Every query with SQL against it, and all of them on edge rows and on an empty table."""

import os

import pytest
from oracle import compare

from moodstream.llm.catalogue import QUERIES, SQL


@pytest.fixture(autouse=True, scope="module")
def registered():
    import moodstream.plans.catalogue as plans

    saved = dict(plans.QUERIES), dict(plans.SQL)
    plans.QUERIES.update(QUERIES)
    plans.SQL.update(SQL)
    yield
    for own, old in zip((plans.QUERIES, plans.SQL), saved, strict=True):
        own.clear()
        own.update(old)


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, con, data, name):
    ok, note = compare(spark, con, data, name)
    assert ok, note


def test_one_query_for_each_operator():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def folders(spark, edge, nothing, tmp_path_factory):
    out = {}
    for name, frame in (("edge", edge), ("empty", nothing)):
        folder = str(tmp_path_factory.mktemp(name))
        frame.selectExpr("doc_id as item_id", "text", "key").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
        frame.coalesce(2).write.parquet(f"{folder}/documents.parquet")
        pages = frame.selectExpr("doc_id as page_id", "source as url", "text as html", "key", "size")
        pages.coalesce(2).write.parquet(f"{folder}/pages.parquet")
        out[name] = folder
    return out


@pytest.mark.parametrize("name", list(QUERIES))
def test_edge_rows_and_empty_table(spark, folders, rows, name):
    found = QUERIES[name](spark, folders["edge"])
    got = found.collect()
    if name.startswith("op4"):
        assert got == []
    elif name.startswith("op13"):
        assert {x.lang for x in got} <= {"en", "de", "ja", "und"}
    else:
        key = "page_id" if name.startswith("op8") else "doc_id"
        assert sorted(str(x[key]) for x in got) == sorted(str(x[0]) for x in rows)
    empty = QUERIES[name](spark, folders["empty"])
    assert empty.collect() == [] and empty.columns == found.columns


def test_pipeline_stages(spark, folders, data):
    import corpus_pipeline

    documents = spark.read.parquet(f"{data}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == documents.columns
    for folder in folders.values():
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        out.collect()


def test_operators_work_on_a_folder_that_only_spark_names(spark, folders):
    path = folders["edge"]
    assert os.path.isabs(path)
    assert QUERIES["op9_repetition_coverage"](spark, f"file://{path}").count() == QUERIES["op9_repetition_coverage"](spark, path).count()
