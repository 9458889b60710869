"""Every registered query against its SQL on the smallest scale."""

import pytest
from oracle import compare

from moodstream.plans.catalogue import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, data, name):
    ok, note = compare(spark, con, data, name)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["batch_ts", "word", "cnt"]
    assert set(e.oracle_sql()) <= set(e.queries())
