"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from moodlens.catalog.oracle import ORACLE_SQL
from moodlens.catalog.queries import QUERIES
from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLE_SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "state_name", "state_code", "count", "total_sentiment", "absolute_sentiment", "mean_sentiment",
    ]
    assert result.count() > 1
