"""Every registered query against its SQL twin on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_sql import compare, connect

import __spark_entry__ as entry
from hearback.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert name in entry.oracle_sql(), "every query has a SQL twin"
    assert compare(df, con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
