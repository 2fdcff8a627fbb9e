"""Every registered query against DuckDB over the same tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from relocate.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    # SQL over views does not see the files behind them.
    assert set(QUERIES) - {"relation_files"} <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"relation_files"}))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
