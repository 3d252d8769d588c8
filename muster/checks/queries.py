"""Every operator as a query over the derived CRM tables of one test data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions.dates import ago
from muster.functions.text import customer_no_cut, customer_no_full, name_by_type, typed_null
from muster.operators import aggregates, filters, joins, lookups, sets, updates
from muster.plans import exports, rules
from muster.schemas import SCHEMAS
from muster.sinks import append, files, follow_up, ids, ledger, place, storage
from muster.sinks.summary import summary
from muster.sources import tables
from muster.sources.derived import AS_OF, CUSTOM_FIELDS, FLOOR_DAY, LINE_DIGEST, ROUTES, DerivedTables, webshop_activity
from muster.sources.local import local_rows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[DerivedTables, SparkSession], DataFrame], name: str | None = None):
    _QUERIES[name or build.__name__] = lambda spark, directory: build(DerivedTables(spark, directory), spark)
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _contacts(t: DerivedTables) -> DataFrame:
    return t["contact"].withColumnRenamed("id", "contact_id")


def _routes(spark: SparkSession) -> DataFrame:
    return tables.routes(spark, ROUTES)


# Sources and sinks.


@_query
def load_tables(t, spark):
    """The derived tables stored, then opened by the loader."""
    folder = place.run_folder(spark)
    for name in SCHEMAS:
        t[name].write.parquet(f"{folder}/{name}.parquet")
    stored = tables.load_tables(spark, folder)
    counts = [
        stored[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in SCHEMAS
    ]
    return reduce(DataFrame.unionByName, counts)


@_query
def pending_orders(t, spark):
    return tables.pending_orders(t).select("id", "source_contact_id", "campaign_id", "order_type", "order_count")


@_query
def custom_field_rename(t, spark):
    renamed = tables.rename_custom(webshop_activity(t), CUSTOM_FIELDS)
    return renamed.select("id", *[name for name in CUSTOM_FIELDS if name != "order_exported_date"])


@_query
def route_table(t, spark):
    table = _routes(spark)
    return exports.with_route(t["webshop_order"], table).join(table, "route_key").select("id", "route_key", "file", "remote")


def _shop_lines(t, spark) -> DataFrame:
    return exports.export_orders(t, _routes(spark))


@_query
def csv_export(t, spark):
    lines = _shop_lines(t, spark).select(*exports.ORDER_KEYS)
    path = f"{place.run_folder(spark)}/file"
    files.write_csv(lines, exports.ORDER_KEYS, path)
    return files.read_csv(spark, path, lines.schema)


@_query
def csv_lines(t, spark):
    return files.csv_lines(_shop_lines(t, spark), exports.ORDER_KEYS)


@_query
def routed_export(t, spark):
    lines = _shop_lines(t, spark)
    path = f"{place.run_folder(spark)}/files"
    files.write_routed(lines, exports.ORDER_KEYS, path)
    return files.read_csv(spark, path, lines.schema)


@_query
def mass_activity(t, spark):
    exported = exports.mailing_base(t).select("contact_id")
    folder = place.run_folder(spark)
    number = ids.reserve(spark, f"{folder}/ids", "export", 1, ids.highest_id(t["activity"]))[0]
    record, links = follow_up.mass_activity(exported, t, AS_OF, number, "Export", "AKTION-7767")
    return _with_links(place.stage(record, f"{folder}/activity"), place.stage(links, f"{folder}/activity_contact"))


def _with_links(records: DataFrame, links: DataFrame) -> DataFrame:
    day = F.date_format("activity_date_time", "yyyy-MM-dd HH:mm:ss").alias("activity_date_time")
    whole = records.withColumnRenamed("id", "activity_id").join(links, "activity_id")
    kept = ["activity_id", "activity_type_id", "campaign_id", "status_id", "subject", "contact_id", "record_type_id"]
    return whole.select(*kept, day)


@_query
def call_tasks(t, spark):
    """Calls with their links. Numbers differ from run to run, so each call is told by the contact it is for."""
    folder = place.run_folder(spark)
    numbered = follow_up.number_calls(exports.export_welcome_call(t, AS_OF), t, f"{folder}/ids", "calls", folder)
    records, links = follow_up.call_tasks(numbered, t, AS_OF)
    wanted = numbered.withColumnRenamed("contact_id", "call_for")
    return _with_links(records, links).join(wanted, "activity_id").drop("activity_id")


@_query
def export_ledger(t, spark):
    """The ledger rows of a run that died before its route 1 was complete, and the orders the next run still finds pending."""
    due, folder = tables.pending_orders(t), place.run_folder(spark)
    book = f"{folder}-ledger"

    def select(taken):
        place.stage(exports.with_route(ledger.not_in_ledger(due, taken), _routes(spark)), f"{folder}/audience", by="route_key")
        return f"{folder}/audience"

    intent = ledger.begin(spark, book, "dead", AS_OF, f"{folder}/file", ["default", "1", "3"], select)
    for route in intent.routes:
        files.write_routed(intent.orders(spark).filter(F.col("route_key") == route), ["id"], intent.folder(route))
        if route != "1":
            storage.mark_complete(spark, intent.folder(route))
    ledger.recover(spark, book, timedelta(0))
    left = ledger.not_in_ledger(due, ledger.taken(spark, book)).select("id", "order_exported", "order_exported_date", "status_id")
    return ledger.read_ledger(spark, book).unionByName(left).withColumn(
        "order_exported_date", F.date_format("order_exported_date", "yyyy-MM-dd HH:mm:ss")
    )


@_query
def export_summary(t, spark):
    table = _routes(spark)
    where = F.concat(F.lit("out/file-"), F.col("route_key"))
    report = summary(exports.with_route(tables.pending_orders(t), table), table, AS_OF, folder=where)
    return report.withColumn("is_error", F.col("is_error").cast("int"))


# Filters.


@_query
def flags_filter(t, spark):
    flags = ["do_not_email", "is_opt_out", "is_deceased", "is_deleted", "do_not_phone"]
    return filters.keep_unflagged(t["contact"], flags).select("id")


@_query
def type_filter(t, spark):
    return filters.filter_type(t["contact"], "Individual").select("id", "contact_type")


@_query
def not_null_after_left_join(t, spark):
    joined = joins.join_primary(_contacts(t), t["email"], ["email"])
    return filters.require(joined, "email").select("contact_id", "email")


@_query
def not_like_prefix(t, spark):
    return filters.not_prefixed(t["contact"], "external_identifier", "USER-").select("id", "external_identifier")


@_query
def in_list(t, spark):
    kinds = t["membership_type"].select(F.col("id").alias("membership_type_id"), F.col("name").alias("membership_type"))
    wanted = lookups.has_value(t["membership"], t["membership_type"], "membership_type_id", "name", ["Guardian", "Baum"])
    named = wanted.join(kinds, "membership_type_id")
    return named.select("id", "membership_type")


def _day(column: str):
    return F.col(column).cast("string").alias(column)


@_query
def rolling_window(t, spark):
    kept = filters.since(t["membership"], "join_date", AS_OF, (6, "MONTH"), until=(2, "DAY"))
    return kept.select("id", _day("join_date"))


@_query
def fixed_floor_date(t, spark):
    return filters.floor_date(t["membership"], "join_date", "2000-02-29").select("id", _day("join_date"))


@_query
def future_filter(t, spark):
    return filters.after(t["contribution_recur"], "next_sched_contribution_date", AS_OF).select("id")


@_query
def run_day_gate(t, spark):
    """All memberships for each of six run days, four of them quiet."""
    runs = [
        filters.run_day_gate(t["membership"], datetime(2001, 7, day, 12)).select("id", F.lit(day).alias("run_day"))
        for day in (1, 2, 9, 15, 16, 24)
    ]
    return reduce(DataFrame.unionByName, runs)


@_query
def or_eligibility(t, spark):
    return filters.postal_disqualified(rules.postal_profile(t, _contacts(t))).select("contact_id")


@_query
def entity_scope(t, spark):
    return filters.link_scope(t["entity_tag"]).select("entity_id", "tag_id")


@_query
def role_filter(t, spark):
    return filters.with_role(t.numbered(LINE_DIGEST)["activity_contact"]).select("activity_id", "contact_id")


# Joins.


@_query
def primary_detail_join(t, spark):
    rows = joins.join_primary(_contacts(t), t["address"], ["street_address"])
    rows = joins.join_primary(joins.join_primary(rows, t["email"], ["email"]), t["phone"], ["phone"])
    return rows.select("contact_id", "street_address", "email", "phone")


@_query
def dimension_lookup_join(t, spark):
    rows = lookups.join_dim(t["address"], t["country"], "country_id", ["iso_code"])
    rows = lookups.join_dim(rows, t["address_statistics"], "id", ["rts_counter"], key="entity_id")
    return rows.select("id", "iso_code", "rts_counter")


@_query
def option_lookup_join(t, spark):
    rows = lookups.option_label(t["contact"], t, "prefix_id", "individual_prefix", out="salutation")
    return rows.select("id", "prefix_id", "salutation")


@_query
def inner_chain(t, spark):
    return joins.with_titles(joins.petitions(t), t)


@_query
def multi_key_join(t, spark):
    titles = t["survey"].select(F.col("id").alias("survey_id"), "title")
    return joins.survey_activities(t, t["survey"]).join(titles, "survey_id")


@_query
def any_phone_join(t, spark):
    return joins.with_phone(_contacts(t), t["phone"]).select("contact_id")


@_query
def hierarchy_join(t, spark):
    return lookups.under_root(t["membership"], t["campaign"], "DD").select("id", "campaign_id")


@_query
def attach_aggregate(t, spark):
    return joins.attach(_contacts(t).select("contact_id"), exports.membership_kinds(t, AS_OF), "contact_id")


@_query
def recurring_payment_join(t, spark):
    rows = joins.with_recurring(t["membership"], t, AS_OF)
    charge = F.date_format("next_sched_contribution_date", "yyyy-MM-dd HH:mm:ss").alias("next_charge")
    return rows.select("id", "payment_instrument", charge)


@_query
def payment_link_join(t, spark):
    return joins.membership_contributions(t.numbered(LINE_DIGEST), ["Completed", "Cancelled"])


@_query
def order_contact_join(t, spark):
    orders = t["webshop_order"]
    rows = joins.with_contact(orders, joins.order_contacts(t, orders))
    return rows.select("id", "source_contact_id", "first_name", "last_name")


# Semi and anti joins.


@_query
def not_in_null_aware(t, spark):
    """Without and with a login of no contact."""
    logins = t["uf_match"]
    unknown = logins.unionByName(local_rows(spark, [(None,)], "contact_id bigint"))
    cases = [
        sets.not_in(_contacts(t), other, "contact_id").select(F.col("contact_id").alias("id"), F.lit(case).alias("nulls"))
        for case, other in enumerate([logins, unknown])
    ]
    return reduce(DataFrame.unionByName, cases)


@_query
def suppress(t, spark):
    sets_out = [rules.tagged(t, rules.TAGS_POST), rules.group_member(t), rules.major_donor(t, AS_OF)]
    return sets.suppress(_contacts(t).select("contact_id"), sets_out, "contact_id")


@_query
def keep(t, spark):
    return sets.keep(_contacts(t).select("contact_id"), rules.recent_direct_debit(t, AS_OF), "contact_id")


@_query
def suppress_membership(t, spark):
    ids = t["membership"].select(F.col("id").alias("membership_id"))
    return sets.suppress(ids, [rules.membership_failed(t), rules.membership_paid(t)], "membership_id")


@_query
def exists_in_contact(t, spark):
    ids = t["webshop_order"].select(F.col("source_contact_id").alias("contact_id")).distinct()
    return sets.existing(ids, t["contact"])


@_query
def in_subquery_filter(t, spark):
    rows = lookups.in_campaigns(t["membership"], t["campaign"], "AKTION-7571", "Campaign NATION_3")
    return rows.select("id", "campaign_id")


# Rules.


@_query
def rule_tagged(t, spark):
    four = rules.tagged(t, rules.TAGS_POST).withColumn("tags", F.lit(4))
    return four.unionByName(rules.tagged(t, rules.TAGS_MAIL_AND_CALL).withColumn("tags", F.lit(2)))


@_query
def rule_group_member(t, spark):
    return rules.group_member(t)


@_query
def rule_major_donor(t, spark):
    return rules.major_donor(t, AS_OF)


@_query
def rule_major_donor_any_status(t, spark):
    return rules.major_donor(t, AS_OF, status=None)


@_query
def rule_major_donor_fanout(t, spark):
    return rules.major_donor_fanout(t, exports.call_base(t, AS_OF), AS_OF)


@_query
def rule_recent_mailing(t, spark):
    return rules.recent_mailing(t, AS_OF)


@_query
def rule_previous_call(t, spark):
    return rules.previous_call(t)


@_query
def rule_campaign_tree_contact(t, spark):
    return rules.campaign_tree_contact(t, AS_OF)


@_query
def rule_membership_failed(t, spark):
    return rules.membership_failed(t)


@_query
def rule_membership_paid(t, spark):
    return rules.membership_paid(t)


@_query
def rule_postal_ineligible(t, spark):
    return rules.postal_ineligible(t)


@_query
def keep_recent_direct_debit(t, spark):
    return rules.recent_direct_debit(t, AS_OF)


@_query
def keep_recruited_membership(t, spark):
    return rules.recruited_membership(t, AS_OF)


# Aggregation and set operations.


@_query
def distinct_rows(t, spark):
    return aggregates.distinct_rows(t["membership"], ["contact_id", "membership_type_id"])


@_query
def sum_having(t, spark):
    rows = aggregates.sum_at_least(t["contribution"], "contact_id", "total_amount", 5000)
    return rows.withColumn("total", F.col("total").cast("double"))


@_query
def concat_distinct_sorted(t, spark):
    return exports.membership_kinds(t, AS_OF)


@_query
def concat_distinct_by_other(t, spark):
    return joins.petition_texts(t)


@_query
def count_per_route(t, spark):
    return aggregates.count_by(exports.with_route(tables.pending_orders(t), _routes(spark)), "route_key")


@_query
def union_ids(t, spark):
    sets_out = [rules.tagged(t, rules.TAGS_MAIL_AND_CALL), rules.group_member(t), rules.major_donor(t, AS_OF, status=None)]
    return sets.union_ids(*sets_out, distinct=True)


@_query
def insert_select_union(t, spark):
    return sets.union_ids(rules.previous_call(t), rules.campaign_tree_contact(t, AS_OF))


@_query
def difference(t, spark):
    rows = aggregates.distinct_rows(t["membership"], ["contact_id", "campaign_id"])
    return sets.suppress(rows, [rules.tagged(t, rules.TAGS_MAIL_AND_CALL), rules.group_member(t)], "contact_id")


# Row-modifying steps.


@_query
def update_from_join(t, spark):
    return updates.add_group_status(_contacts(t).select("contact_id"), t, exports.STATUS_GROUPS)


@_query
def update_from_aggregate(t, spark):
    return joins.attach(_contacts(t).select("contact_id"), joins.petition_texts(t), "contact_id")


@_query
def assert_unique_key(t, spark):
    """The check that exports rely on, on a table that passes (its rows) and one that fails (its repeated keys)."""

    def tried(name: str, rows: DataFrame, key: str) -> DataFrame:
        try:
            count = updates.unique_or_fail(rows, key).count()
        except (Py4JJavaError, PySparkException) as error:
            if f"duplicate key {key}=" not in str(error):
                raise
            found = updates.duplicate_keys(rows, key).select(F.col(key).cast("bigint").alias("key"), "copies")
        else:
            found = local_rows(spark, [(None, count)], "key bigint, copies bigint")
        return found.withColumn("table_name", F.lit(name))

    return tried("contact", t["contact"], "id").unionByName(tried("address", t["address"], "contact_id"))


@_query
def insert_ignore(t, spark):
    rows = t["membership"].select(
        "contact_id", F.lit(2).cast("bigint").alias("group_id"), F.lit("Added").alias("status")
    )
    key, target = ["contact_id", "group_id"], f"{place.run_folder(spark)}/group_contact"
    # A repeated run and a second one add nothing.
    for run_id in ("first", "first", "second"):
        append.append_new(rows, target, key, run_id, t["group_contact"])
    return append.read_parts(spark, target, rows.schema).withColumn("group_id", F.col("group_id").cast("int"))


# Expressions.


@_query
def scalar_lookup(t, spark):
    group_id = lookups.lookup_id(t["group"], F.col("title") == "Community NL")
    return t["group_contact"].filter(F.col("group_id") == group_id).select("contact_id", "status")


@_query
def customer_number_sql(t, spark):
    campaign = F.nullif(F.col("id") % 9, F.lit(0)) * 12345
    number = customer_no_cut(campaign, F.col("contact_id") * 1000003).alias("kundennummer")
    return t["membership"].select("id", number)


@_query
def customer_number_app(t, spark):
    number = customer_no_full(F.col("campaign_id") * 777, F.col("source_contact_id") * 100000007)
    return t["webshop_order"].select("id", number.alias("kundennummer"))


def _names(t, spark):
    return t["contact"].select("id", name_by_type().alias("nachname"))


_query(_names, "name_by_type")


@_query
def typed_null_columns(t, spark):
    return t["contact"].select("id", typed_null("int").alias("package_id"), typed_null("string").alias("co"))


@_query
def project_keys(t, spark):
    return exports.project(exports.welcome_email_base(t), exports.EMAIL_KEYS)


@_query
def option_label(t, spark):
    rows = lookups.option_label(t["webshop_order"], t, "order_type", "order_type", out="item")
    return rows.select("id", "order_type", "item")


@_query
def route_key(t, spark):
    return exports.with_route(t["webshop_order"], _routes(spark)).select("id", "route_key")


@_query
def date_ago(t, spark):
    def back(n: int, unit: str, name: str):
        return ago(F.col("join_date"), n, unit).cast("string").alias(name)

    return t["membership"].select(
        "id", back(6, "MONTH", "six_months"), back(2, "DAY", "two_days"), back(1, "YEAR", "one_year")
    )


# Exports.


@_query
def export_mailing(t, spark):
    return exports.export_mailing(t).withColumn("Birthday", F.col("Birthday").cast("string"))


@_query
def export_welcome_post(t, spark):
    return exports.export_welcome_post(t, AS_OF)


@_query
def export_welcome_email(t, spark):
    return exports.export_welcome_email(t, AS_OF, FLOOR_DAY)


@_query
def export_welcome_call(t, spark):
    return exports.export_welcome_call(t, AS_OF)


@_query
def export_orders(t, spark):
    return _shop_lines(t, spark)

