"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from tickengine.plans.registry import ORACLES, QUERIES

SF_DIR = driver.SMOKE_DIR
TABLES = ["events", "lineitem", "orders"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    found = QUERIES[name](spark, SF_DIR)
    relation = oracle.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(relation.columns)
    assert rows(found.columns, map(tuple, found.collect())) == rows(
        relation.columns, relation.fetchall()
    )


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0
