"""Every registered query against its DuckDB SQL on the same files."""

from __future__ import annotations

import os

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from muster.checks import queries, queries_sql

DIRECTORY = os.environ.get("MUSTER_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


def test_every_query_has_an_expected_result():
    assert set(queries.queries()) == set(queries_sql.oracle_sql())
    assert set(queries.queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_same_rows(spark, duck, name):
    columns, found = spark_rows(queries.queries()[name](spark, DIRECTORY))
    expected_columns, expected = duck_rows(duck, queries_sql.oracle_sql()[name])
    assert columns == expected_columns
    assert expected, "an empty expectation checks nothing"
    assert found - expected == {} and expected - found == {}


def test_entry(spark):
    assert driver.entry(spark).count() == 57
