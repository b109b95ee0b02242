"""Every registered query against the SQL that defines it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from rowharbor.catalog import ORACLES, QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, con, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1
