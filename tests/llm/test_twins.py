"""Queries with SQL twins against DuckDB."""

import pytest
from check_sql import compare, connect

import __spark_entry__ as entry
from hearback.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, small, name):
    assert compare(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) == ""


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
