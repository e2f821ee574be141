"""Every query against its SQL twin at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, name, sf)
    # A query without SQL twin must return rows; one with a twin must equal it.
    assert ok, note


@pytest.mark.parametrize("name", ["fm_cross_terms", "recent_items", "history_attention_pool", "train_mlp"])
def test_query_on_more_rows(spark, name):
    """Cases that the smallest tables do not hold, such as a user without a favourite genre."""
    more = "/root/testdata/sf0.01"
    ok, note = compare(spark, connect(more), name, more)
    assert ok, note


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert "userGenre5" in df.columns


def test_twins_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
