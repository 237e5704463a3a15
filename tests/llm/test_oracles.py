"""Registered queries against their SQL."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_point
from textloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, data, name):
    compare(queries.QUERIES[name](spark, data), connect(data), queries.ORACLES[name])


def test_all_are_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(queries.ORACLES) <= set(entry_point.oracle_sql())
