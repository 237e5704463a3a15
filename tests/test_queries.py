"""Every registered query against its SQL."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_point
from textloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="session")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, con, name):
    compare(QUERIES[name](spark, data), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["text", "id", "source", "metadata_json"]
    assert df.count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
