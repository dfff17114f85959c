"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as contract
from callmeter.plans.queries import QUERIES
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, con, contract.oracle_sql()[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
