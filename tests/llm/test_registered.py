"""The registered queries: names, columns, and their SQL where there is one."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from muster.llm import queries

DIRECTORY = "/root/testdata/sf0.01"


def test_every_operator_and_the_pipeline_are_registered():
    names = set(queries.queries())
    assert {name.split("_")[0] for name in names} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert names <= set(driver.queries())
    assert set(queries.oracle_sql()) <= names


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    columns, found = spark_rows(queries.queries()[name](spark, DIRECTORY))
    expected_columns, expected = duck_rows(connect(DIRECTORY), queries.oracle_sql()[name])
    assert columns == expected_columns
    assert expected and found == expected


@pytest.mark.parametrize("name", ["op2_blob_ledger", "op5_weighted_mix", "op10_surrogates", "op12_divergence"])
def test_native_operators_run_no_python(spark, name):
    df = queries.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "ArrowEval", "MapIn", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
