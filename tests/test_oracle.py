"""Every registered query against its SQL on the whole test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from repopulse.plans.catalogue import QUERIES
from repopulse.plans.oracle import ORACLE
from tests.oracle_compare import connect, oracle_rows, spark_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    names, rows = spark_rows(entry_point.queries()[name](spark, SF_DIR))
    expected_names, expected = oracle_rows(duck, entry_point.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
    assert rows, "the query must return rows on the test tables"


def test_entry_point(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
