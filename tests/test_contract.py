from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from adtrail.plans.queries import ORACLE, QUERIES
from check import TABLES, normal

SF_DIR = "/root/testdata/sf0.001"
# The queries of the text operators are tested with them.


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF_DIR).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)
    assert len(ours) > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 36694
