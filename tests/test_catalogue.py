"""Every registered query against its SQL twin."""

import os

import pytest

import catalogue
import __spark_entry__ as driver
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalogue.QUERIES, catalogue.SQL


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r["row_no"] for r in rows] == list(range(1, 11))
