"""Corpus queries that SQL can express, against DuckDB."""

import pytest

from callmeter.llm import sharding
from callmeter.llm.queries import ORACLE_SQL, QUERIES, sharding_sql
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) is None


@pytest.mark.parametrize("limit", [20_000, 3_000])
def test_shards_split_where_they_are_too_large(spark, con, limit):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert difference(sharding.shard_documents(docs, limit), con, sharding_sql(limit)) is None
