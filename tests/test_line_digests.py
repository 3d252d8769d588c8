"""Queries over lines numbered by their digest: lines of one order, number and price but other parts are different lines."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest
from compare import duck_rows, spark_rows

from muster.checks import queries, queries_sql

DAY = datetime(2001, 7, 1)
#: (order, line, part, supplier, return flag)
LINES = [(1, 2, 10, 5, "N"), (1, 2, 11, 5, "A"), (1, 2, 11, 6, "R"), (2, 2, 10, 5, "A"), (2, 3, 10, 5, "N"), (4, 2, 10, 5, "A")]


@pytest.fixture(scope="module")
def directory(tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE lineitem (l_orderkey BIGINT, l_linenumber INTEGER, l_partkey BIGINT, l_suppkey BIGINT,"
        " l_extendedprice DOUBLE, l_quantity DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP)"
    )
    con.executemany(
        "INSERT INTO lineitem VALUES (?, ?, ?, ?, 100.0, 1, ?, 'F', ?)", [(o, n, p, s, flag, DAY) for o, n, p, s, flag in LINES]
    )
    con.execute("CREATE TABLE orders AS SELECT k AS o_orderkey, 7 * k AS o_custkey FROM (VALUES (1), (2), (4)) v(k)")
    for name in ("lineitem", "orders"):
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def _rows(spark, directory, name):
    _, found = spark_rows(queries.queries()[name](spark, directory))
    con = duckdb.connect()
    for table in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    assert found == duck_rows(con, queries_sql.oracle_sql()[name])[1]
    return sorted(found.elements())


def test_links_of_like_lines_keep_their_numbers(spark, directory):
    rows = _rows(spark, directory, "role_filter")
    assert sorted(contact for _, contact in rows) == [7, 7, 7, 14, 28]
    assert len({activity for activity, _ in rows}) == 5


def test_payments_of_like_lines_keep_their_own_status(spark, directory):
    rows = _rows(spark, directory, "payment_link_join")
    # The pending line of order 1 is no payment; with one number for all three it was.
    assert sorted(membership for _, membership in rows) == [1, 1, 2]
    assert len({contribution for contribution, _ in rows}) == 3
