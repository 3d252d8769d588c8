"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from muster.checks import queries
from muster.plans import exports, rules
from muster.schemas import SCHEMAS
from muster.sources.derived import AS_OF, FLOOR_DAY, ROUTES, DerivedTables
from muster.sources.tables import load_tables, routes

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables written out, so that plans show real scans."""
    folder = str(tmp_path_factory.mktemp("crm"))
    derived = DerivedTables(spark, SMALL)
    for name in SCHEMAS:
        derived[name].write.parquet(f"{folder}/{name}.parquet")
    return load_tables(spark, folder)


def _plan(df, threshold: int = 10 * 1024 * 1024) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(threshold))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        # A fresh frame: a plan is made once per frame.
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def _five(t, spark):
    return {
        "mailing": exports.export_mailing(t),
        "post": exports.export_welcome_post(t, AS_OF),
        "email": exports.export_welcome_email(t, AS_OF, FLOOR_DAY),
        "call": exports.export_welcome_call(t, AS_OF),
        "orders": exports.export_orders(t, routes(spark, ROUTES)),
    }


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"csv_export", "routed_export"}))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(queries.queries()[name](spark, SMALL))
    for word in ("Python", "ArrowEval", "MapIn", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, word


def test_filters_and_columns_reach_the_scans(stored):
    plan = _plan(rules.recent_direct_debit(stored, AS_OF))
    bounds = r"GreaterThanOrEqual\(join_date,2001-01-16\)[^]]*LessThan\(join_date,2001-07-14\)"
    assert re.search(rf"PushedFilters: \[[^]]*{bounds}", plan)
    assert "ReadSchema: struct<id:bigint,contact_id:bigint,join_date:date,status_id:int>" in plan
    plan = _plan(rules.major_donor(stored, AS_OF))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(receive_date,2000-07-15T12:00\)", plan)
    plan = _plan(exports.welcome_email_base(stored))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(is_deceased,0\)", plan)
    assert "ReadSchema: struct<id:bigint,hash:string,do_not_email:int,is_opt_out:int,is_deceased:int,is_deleted:int>" in plan


def test_left_join_with_required_column_becomes_inner(stored):
    plan = _plan(exports.welcome_email_base(stored))
    assert "Inner" in plan and "LeftOuter" not in plan


def test_one_anti_join_per_key(stored, spark):
    counts = {name: _plan(df, -1).count("LeftAnti") for name, df in _five(stored, spark).items()}
    assert counts == {"mailing": 1, "post": 1, "email": 1, "call": 2, "orders": 0}


def test_large_tables_are_read_once(stored, spark):
    plans = {name: _plan(df) for name, df in _five(stored, spark).items()}

    def scans(name, table):
        return len(re.findall(rf"FileScan parquet .*/{table}\.parquet", plans[name]))

    assert scans("mailing", "activity_contact") == scans("mailing", "activity") == 1
    assert scans("post", "contact") == scans("post", "address") == scans("post", "activity_contact") == 1
    assert scans("call", "activity_contact") == scans("call", "contribution") - 1 == 1
    # Once as links, once for the keys that cut the contributions.
    assert scans("call", "membership_payment") == 2
    assert scans("email", "contribution") == 1


def test_building_an_export_runs_no_job(stored, spark):
    context = spark.sparkContext
    context.setJobGroup("build", "building only")
    try:
        _five(stored, spark)
        assert context.statusTracker().getJobIdsForGroup("build") == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def _depth(line: str) -> int:
    return len(re.match(r"[ :]*", line)[0])


def _above(plan: str, table: str) -> list[str]:
    """The operators above each scan of a table, from the scan upwards, as one text per scan."""
    lines = plan.splitlines()
    found = []
    for number, line in enumerate(lines):
        if f"/{table}.parquet" not in line:
            continue
        depth = _depth(line)
        path = []
        for above in reversed(lines[:number]):
            level = _depth(above)
            if level < depth:
                depth = level
                path.append(above)
        found.append("\n".join(path))
    return found


@pytest.mark.parametrize("threshold", [10 * 1024 * 1024, -1])
def test_large_tables_are_cut_before_anything_else(stored, threshold):
    """Links, addresses and gifts meet the members' ids first: without a shuffle where these are few by Spark's own
    statistics, else behind the shuffle on the contact that the next step needs."""
    for export in (exports.export_welcome_post, exports.export_welcome_call):
        plan = _plan(export(stored, AS_OF), threshold)
        for table in ("activity_contact", "address" if "post" in export.__name__ else "membership_payment"):
            for path in _above(plan, table):
                first_join = next(line for line in path.splitlines() if "Join" in line)
                assert "LeftSemi" in first_join, (export, table, first_join)
                before = path[: path.index(first_join)]
                assert ("Exchange hashpartitioning" in before) == (threshold == -1)


def test_mailing_cuts_links_before_the_first_grouping(stored):
    (path,) = _above(_plan(exports.export_mailing(stored), -1), "activity_contact")
    assert path.index("LeftSemi") < path.index("HashAggregate")


def test_campaigns_are_read_once_per_generation(stored):
    plan = _plan(exports.export_welcome_call(stored, AS_OF))
    assert len(re.findall(r"FileScan parquet .*/campaign\.parquet", plan)) <= 8
    assert len(re.findall(r"FileScan parquet .*/activity\.parquet", plan)) == 1
    plan = _plan(rules.campaign_tree_contact(stored, AS_OF))
    assert len(re.findall(r"FileScan parquet .*/campaign\.parquet", plan)) <= 4


def test_quiet_day_reads_no_memberships(stored):
    plan = _plan(exports.call_base(stored, AS_OF.replace(day=16)))
    assert "LocalTableScan <empty>" in plan and "FileScan" not in plan


def test_key_check_adds_no_shuffle(stored):
    with_check = _plan(exports.export_mailing(stored), -1)
    without = _plan(exports.export_mailing(stored, checked=False), -1)
    assert with_check.count("Exchange hashpartitioning") == without.count("Exchange hashpartitioning")
    assert "Window [count(1)" in with_check and "Window [count(1)" not in without


def test_rules_meet_the_audience_without_another_shuffle(stored):
    """All rule sets are distinct by contact already; their union keeps that partitioning."""
    plan = _plan(exports.export_welcome_email(stored, AS_OF, FLOOR_DAY), -1)
    union = plan[plan.index("Union") - 120 : plan.index("Union")]
    assert "Exchange" not in union


def test_code_tables_are_broadcast_by_size(stored):
    df = exports.mailing_base(stored)
    assert "BroadcastHashJoin" in _plan(df)
    assert "BroadcastHashJoin" not in _plan(df, -1)
