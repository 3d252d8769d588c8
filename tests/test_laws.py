"""Properties that hold for any data, checked on the test tables and on tables with very frequent keys."""

from __future__ import annotations

from functools import reduce

import pytest
from compare import TABLES, connect, duck_rows, spark_rows
from crm_rows import OPTION_GROUPS, values
from pyspark.sql import functions as F

import __spark_entry__ as driver
from muster.operators import joins, sets
from muster.plans import exports, rules
from muster.sources.derived import AS_OF, FLOOR_DAY, DerivedTables

DIRECTORY = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    return DerivedTables(spark, DIRECTORY)


def _post_rules(t):
    return [
        rules.postal_ineligible(t),
        rules.tagged(t, rules.TAGS_POST),
        rules.group_member(t),
        rules.major_donor(t, AS_OF),
        rules.recent_mailing(t, AS_OF),
    ]


def test_post_export_is_disjoint_from_each_rule(t):
    audience = exports.export_welcome_post(t, AS_OF).select("contact_id")
    assert not audience.isEmpty()
    for rule in _post_rules(t):
        assert sets.keep(audience, rule, "contact_id").isEmpty()


def test_email_export_is_disjoint_from_each_rule(t):
    audience = exports.export_welcome_email(t, AS_OF, FLOOR_DAY).select("contact_id")
    assert not audience.isEmpty()
    for rule in (
        rules.tagged(t, rules.TAGS_MAIL_AND_CALL), rules.group_member(t), rules.major_donor(t, AS_OF, status=None)
    ):
        assert sets.keep(audience, rule, "contact_id").isEmpty()


def test_one_suppression_equals_one_after_the_other(t):
    base = rules.recent_direct_debit(t, AS_OF)
    at_once = sets.suppress(base, _post_rules(t), "contact_id")
    in_turn = reduce(lambda left, rule: sets.suppress(left, [rule], "contact_id"), reversed(_post_rules(t)), base)
    assert values(at_once, "contact_id") == values(in_turn, "contact_id") != []
    assert values(exports.export_welcome_post(t, AS_OF), "contact_id") == values(at_once, "contact_id")


def test_call_export_equals_the_row_by_row_form(t):
    """Suppress and keep on (contact, membership) rows, as the rules are worded, then distinct contacts."""
    rows = sets.suppress(
        exports.call_base(t, AS_OF),
        [
            rules.tagged(t, rules.TAGS_MAIL_AND_CALL),
            rules.major_donor_fanout(t, exports.call_base(t, AS_OF), AS_OF),
            rules.previous_call(t),
            rules.campaign_tree_contact(t, AS_OF),
        ],
        "contact_id",
    )
    rows = sets.suppress(rows, [rules.membership_failed(t), rules.membership_paid(t)], "membership_id")
    rows = sets.keep(rows, rules.recruited_membership(t, AS_OF), "membership_id").select("contact_id").distinct()
    assert values(exports.export_welcome_call(t, AS_OF), "contact_id") == values(rows, "contact_id") != []


def test_settled_is_failed_or_paid(t):
    both = sets.union_ids(rules.membership_failed(t), rules.membership_paid(t), distinct=True)
    assert values(rules.membership_settled(t), "membership_id") == values(both, "membership_id")


@pytest.mark.parametrize("fanout", [True, False])
def test_rules_about_some_ids_equal_the_rules_about_all(t, fanout):
    """What a rule finds among given ids is what it finds at all, limited to these."""
    some = t["membership"].filter("id % 3 = 0")
    ids = some.filter("contact_id is not null").select("contact_id").distinct()
    for rule in (
        lambda ids: rules.major_donor(t, AS_OF, ids=ids),
        lambda ids: rules.recent_mailing(t, AS_OF, ids=ids),
        lambda ids: exports.call_suppressed(t, AS_OF, fanout, ids),
        lambda ids: exports.callable_contacts(t, ids),
    ):
        limited = sets.within(rule(None).select("contact_id").distinct(), ids, "contact_id")
        asked = sets.within(rule(ids).select("contact_id").distinct(), ids, "contact_id")
        assert values(asked, "contact_id") == values(limited, "contact_id") != []
    links = some.select(F.col("id").alias("membership_id"))
    limited = sets.within(rules.membership_settled(t), links, "membership_id")
    assert values(rules.membership_settled(t, links), "membership_id") == values(limited, "membership_id") != []


def test_call_history_is_both_rules(t):
    both = sets.union_ids(rules.call_activities(t), rules.tree_activities(t, AS_OF), distinct=True)
    assert values(rules.call_history(t, AS_OF), "activity_id") == values(both, "activity_id") != []


# Frequent keys.


@pytest.fixture
def splitting(spark):
    """Many shuffle partitions, no broadcasts, and splitting from small sizes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "500",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_orders_of_frequent_contacts_are_split(crm, spark, splitting):
    """One contact holds a third of all orders and 150 hold 0.22 % each: no task gets much more than its share.

    A frequent contact is split by the tasks that read its orders, so there have to be many of these.
    """
    t = crm(option_group=OPTION_GROUPS)
    rows, tasks = 200_000, 500
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1 + F.col("id") % 150).otherwise(F.col("id") % 5000)
    orders = spark.range(rows).select("id", key.cast("bigint").alias("source_contact_id")).repartition(400)
    t["contact"] = t["contact"].unionByName(
        spark.range(5000).select("id", F.lit("Individual").alias("contact_type")), allowMissingColumns=True
    )
    joined = joins.with_contact(orders, joins.order_contacts(t, orders))
    placed = joined.select("id", F.spark_partition_id().alias("task")).cache()
    try:
        sizes = [row["count"] for row in placed.groupBy("task").count().collect()]
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        placed.unpersist()
    assert sum(sizes) == rows
    assert "skew=true" in plan
    assert max(sizes) < 8 * rows / tasks


def test_links_of_a_mass_mailing_are_split(spark):
    """Half of all links belong to one activity; adaptive execution deals them out over several tasks."""
    links = spark.range(400_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("activity_id"),
        F.xxhash64("id").alias("contact_id"),
        F.lit(3).alias("record_type_id"),
    )
    activities = spark.range(50_000).select(F.col("id").alias("activity_id"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        reached = rules.activity_targets({"activity_contact": links}, activities)
        reached.collect()
        plan = reached._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    assert reached.count() == 200_000 + 25_000


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Test tables in which one customer, order, part and user hold a third of the rows each."""
    import duckdb

    folder = tmp_path_factory.mktemp("skewed")
    changes = {
        "orders": "REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE o_custkey END AS o_custkey)",
        "lineitem": "REPLACE (CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,"
        " CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey)",
        "events": "REPLACE (CASE WHEN event_id % 3 = 1 THEN 5 ELSE user_id END AS user_id)",
    }
    for table in TABLES:
        duckdb.sql(
            f"COPY (SELECT * {changes.get(table, '')} FROM '/root/testdata/sf0.001/{table}.parquet')"
            f" TO '{folder}/{table}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "export_mailing", "export_welcome_post", "export_welcome_email", "export_welcome_call", "export_orders",
        "rule_major_donor_fanout", "rule_previous_call", "inner_chain", "order_contact_join", "concat_distinct_by_other",
    ],
)
def test_same_rows_with_frequent_keys(spark, skewed, name):
    columns, found = spark_rows(driver.queries()[name](spark, skewed))
    expected_columns, expected = duck_rows(connect(skewed), driver.oracle_sql()[name])
    assert columns == expected_columns and found == expected


@pytest.mark.parametrize("name", ["export_mailing", "export_welcome_post", "export_welcome_call", "export_orders"])
def test_same_rows_without_any_broadcast(spark, name):
    """Tables over the broadcast threshold are shuffled instead, with the same result."""
    usual = spark_rows(driver.queries()[name](spark, DIRECTORY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert spark_rows(driver.queries()[name](spark, DIRECTORY)) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
