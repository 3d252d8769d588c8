"""Hand-made rows for the points that are easy to get wrong."""

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from crm_rows import OPTION_GROUPS, option, values
from pyspark.sql import functions as F

from muster.functions.dates import ago
from muster.functions.text import customer_no_cut, customer_no_full
from muster.operators import aggregates, filters, joins, lookups, sets, updates
from muster.plans import exports, rules
from muster.sources.local import local_rows
from muster.sources.tables import pending_orders, rename_custom, routes

AS_OF = datetime(2001, 7, 15, 12)


# NOT IN, prefixes, NULL logic.


@pytest.mark.parametrize(("logins", "left"), [([], [1, 2]), ([2], [1]), ([2, None], [])])
def test_not_in_with_nulls(spark, logins, left):
    ids = local_rows(spark, [(1,), (2,)], "contact_id bigint")
    other = local_rows(spark, [(login,) for login in logins], "contact_id bigint")
    assert values(sets.not_in(ids, other, "contact_id"), "contact_id") == left
    ids.createOrReplaceTempView("ids")
    other.createOrReplaceTempView("other")
    plain = spark.sql("SELECT * FROM ids WHERE contact_id NOT IN (SELECT contact_id FROM other)")
    assert values(plain, "contact_id") == left


def test_prefix_drops_null_and_keeps_other_case(spark):
    rows = local_rows(spark, [(None,), ("USER-1",), ("user-1",), ("XUSER-1",)], "code string")
    assert values(filters.not_prefixed(rows, "code", "USER-"), "code") == ["XUSER-1", "user-1"]


def _person(number, **changes):
    person = {
        "id": number, "contact_type": "Individual", "first_name": "A", "last_name": "B",
        "is_deleted": 0, "is_deceased": 0, "do_not_mail": 0,
    }
    return person | changes


def _home(number, **changes):
    home = {
        "id": 10 * number, "contact_id": number, "is_primary": 1, "street_address": "s", "postal_code": "1",
        "city": "c", "country_id": 1,
    }
    return home | changes


def test_postal_rule_is_three_valued(crm):
    t = crm(
        contact=[
            _person(1),
            _person(2, first_name=""),
            _person(3, first_name=None),
            _person(4, contact_type="Household", last_name=None),
            _person(5, contact_type="Household", household_name="H", first_name=None),
            _person(6, contact_type="Organization"),
            _person(7),
            _person(8),
            _person(9),
            _person(10),
            _person(11, do_not_mail=None),
        ],
        address=[
            *[_home(n) for n in (1, 2, 3, 4, 5, 6, 11)],
            _home(7, country_id=None),
            _home(8),
            _home(10, country_id=2),
        ],
        address_statistics=[{"entity_id": 80, "rts_counter": 2}, {"entity_id": 10, "rts_counter": None}],
        country=[{"id": 1, "iso_code": "AT"}, {"id": 2, "iso_code": "DE"}],
    )
    # 9 has no address at all; an unknown country (7) or counter (1) alone does not disqualify.
    assert values(rules.postal_ineligible(t), "contact_id") == [3, 4, 6, 8, 9, 10]


# Dates.


def test_window_bounds_on_a_date(spark):
    days = [date(2001, 1, d) for d in (14, 15, 16)] + [date(2001, 7, d) for d in (12, 13, 14)]
    rows = local_rows(spark, [(day,) for day in days], "join_date date")
    kept = filters.since(rows, "join_date", AS_OF, (6, "MONTH"), until=(2, "DAY"))
    # The first bound is noon of 15 January, the second one noon of 13 July.
    assert values(kept, "join_date") == [date(2001, 1, 16), date(2001, 7, 12), date(2001, 7, 13)]


def test_window_bounds_at_midnight(spark):
    rows = local_rows(spark, [(date(2001, 7, d),) for d in (12, 13, 14)], "join_date date")
    kept = filters.since(rows, "join_date", datetime(2001, 7, 15), (2, "DAY"), until=(1, "DAY"))
    assert values(kept, "join_date") == [date(2001, 7, 13)]


def test_window_on_a_timestamp(spark):
    moments = [datetime(2001, 6, 15, 11, 59, 59), datetime(2001, 6, 15, 12), datetime(2030, 1, 1)]
    rows = local_rows(spark, [(m,) for m in moments], "at timestamp_ntz")
    assert values(filters.since(rows, "at", AS_OF, (1, "MONTH")), "at") == moments[1:]


@pytest.mark.parametrize(
    ("as_of", "expected"),
    [(datetime(2000, 8, 31), "2000-02-29"), (datetime(2001, 8, 31), "2001-02-28"), (datetime(2000, 2, 29), "1999-08-29")],
)
def test_months_clamp(spark, as_of, expected):
    assert spark.range(1).select(ago(as_of, 6, "MONTH").cast("date").cast("string")).first()[0] == expected


def test_leap_day_a_year_ago(spark):
    assert spark.range(1).select(ago(datetime(2000, 2, 29), 1, "YEAR").cast("string")).first()[0][:10] == "1999-02-28"


@pytest.mark.parametrize(("day", "count"), [(1, 3), (2, 0), (9, 0), (16, 0), (24, 0), (25, 3)])
def test_quiet_days(spark, day, count):
    assert filters.run_day_gate(spark.range(3), datetime(2001, 7, day, 12)).count() == count


# Codes and lookups.


def test_text_code_against_number(crm, spark):
    t = crm(option_group=OPTION_GROUPS, option_value=[option("order_type", "abc", "X"), option("order_type", "3", "Three")])
    rows = local_rows(spark, [("3",), ("abc",), (None,), ("4",)], "order_type string")
    labelled = lookups.option_label(rows, t, "order_type", "order_type")
    assert {r.order_type: r.label for r in labelled.collect()} == {"3": "Three", "abc": None, None: None, "4": None}


def test_options_of_another_group_do_not_match(crm, spark):
    t = crm(
        option_group=OPTION_GROUPS,
        option_value=[option("contribution_status", "1", "Completed"), option("activity_status", "2", "Completed")],
    )
    rows = local_rows(spark, [(1,), (2,), (None,)], "status int")
    assert values(lookups.has_option(rows, t, "status", "contribution_status", ["Completed"]), "status") == [1]


def test_scalar_lookup_none_and_two(crm):
    groups = [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}, {"id": 3, "title": "b"}]
    t = crm(group=groups, group_contact=[{"contact_id": 9, "group_id": 1}])

    def members(title):
        return t["group_contact"].filter(F.col("group_id") == lookups.lookup_id(t["group"], F.col("title") == title))

    assert members("a").count() == 1
    assert members("none").count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        members("b").collect()


def test_hierarchy_reaches_three_ancestors(crm, spark):
    chain = [{"id": 10, "name": "DD"}] + [{"id": 10 + n, "name": f"n{n}", "parent_id": 9 + n} for n in range(1, 6)]
    loose = [{"id": 30, "name": "x", "parent_id": None}, {"id": 31, "name": "y", "parent_id": 99}]
    t = crm(campaign=chain + loose)
    rows = local_rows(spark, [(c,) for c in (10, 11, 12, 13, 14, 15, 30, 31, None)], "campaign_id bigint")
    assert values(lookups.under_root(rows, t["campaign"], "DD"), "campaign_id") == [10, 11, 12, 13]
    assert values(lookups.under_root(rows, t["campaign"], "DD", max_depth=4), "campaign_id") == [10, 11, 12, 13, 14]


def test_hierarchy_with_a_cycle_counts_once(crm, spark):
    t = crm(campaign=[{"id": 1, "name": "DD", "parent_id": 2}, {"id": 2, "name": "x", "parent_id": 1}])
    rows = local_rows(spark, [(1,), (2,)], "campaign_id bigint")
    assert values(lookups.under_root(rows, t["campaign"], "DD"), "campaign_id") == [1, 2]


# Texts.


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_concatenation_by_first_activity(spark, width):
    rows = [
        (1, 0, "b", 5), (1, 0, "a", 7), (1, 0, None, 1), (1, 0, "c", 5), (1, 1, "T2", 5), (1, 1, "T1", 7), (1, 1, "T3", 1),
        (2, 0, None, 3), (2, 1, None, 3), (3, 0, "z", 2), (3, 1, "Z", 2), (4, 0, "", -4), (4, 1, "x, y", 0),
    ]
    df = local_rows(spark, rows, "contact_id bigint, kind int, text string, activity_id bigint")
    texts = aggregates.concat_by_range(df, "contact_id", ["petition", "topic"], "activity_id", width)
    # Equal first activities ('b' and 'c' at 5) are ordered by text.
    assert {r.contact_id: (r.petition, r.topic) for r in texts.collect()} == {
        1: ("b, c, a", "T3, T2, T1"),
        2: (None, None),
        3: ("z", "Z"),
        4: ("", "x, y"),
    }


def test_petition_texts_of_one_contact_with_a_third_of_all_links(crm, spark):
    """Equal titles of several surveys and campaigns count once; the frequent contact is many lists."""
    surveys = [{"id": n, "title": f"Title {n % 400:03d}" if n % 9 else None, "campaign_id": n % 7, "activity_type_id": 32} for n in range(500)]
    campaigns = [{"id": n, "title": f"Topic {n // 2}"} for n in range(7)]
    links = []
    for n in range(3000):
        contact = 1 if n % 3 == 0 else 2 + n % 200
        links.append((10 * n + 3, contact, (n * 37) % 500))
    t = crm(
        survey=surveys,
        campaign=campaigns,
        option_group=OPTION_GROUPS,
        option_value=[option("activity_type", "32", "Petition")],
        activity=[{"id": a, "activity_type_id": 32, "source_record_id": s} for a, _, s in links],
        activity_contact=[{"activity_id": a, "contact_id": c, "record_type_id": 3} for a, c, _ in links],
    )
    found = {r.contact_id: (r.petition, r.campaign_topic) for r in joins.petition_texts(t).collect()}
    expected = {}
    for activity, contact, survey in sorted(links):
        seen = expected.setdefault(contact, ([], []))
        for texts, text in zip(seen, (surveys[survey]["title"], campaigns[survey % 7]["title"]), strict=True):
            if text is not None and text not in texts:
                texts.append(text)
    assert found == {c: tuple(", ".join(texts) if texts else None for texts in seen) for c, seen in expected.items()}
    assert len(found[1][0].split(", ")) > 300
    parts = joins.petition_texts(t)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[contact_id#\d+L, kind#\d+, _range#\d+L\]", parts)


def test_sorted_concatenation(spark):
    df = local_rows(spark, [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, x string")
    assert {r.k: r.x for r in aggregates.concat_distinct(df, "k", "x").collect()} == {1: "a, b", 2: None}


def test_long_concatenation_is_not_cut(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.format_string("text %05d", "id").alias("x"))
    text = aggregates.concat_distinct(df, "k", "x").first().x
    assert len(text) == 3000 * 12 - 2


def test_customer_numbers(spark):
    rows = local_rows(spark, [(None, 1), (7, 42), (123456, 1234567890)], "campaign bigint, contact bigint")
    cut = customer_no_cut(F.col("campaign"), F.col("contact")).alias("cut")
    full = customer_no_full(F.col("campaign"), F.col("contact")).alias("full")
    assert [tuple(r) for r in rows.select(cut, full).collect()] == [
        (None, "0000C000000001"),
        ("00007C000000042", "0007C000000042"),
        ("12345C123456789", "123456C1234567890"),
    ]


# Sums.


def _gift(contact, amount, day=datetime(2001, 7, 1), status=1):
    return {
        "id": 1, "contact_id": contact, "total_amount": Decimal(amount), "receive_date": day,
        "contribution_status_id": status,
    }


STATUS = [option("contribution_status", "1", "Completed"), option("contribution_status", "2", "Pending")]


def test_major_donor_threshold(crm):
    t = crm(
        option_group=OPTION_GROUPS,
        option_value=STATUS,
        contribution=[
            _gift(1, "1000.00"),
            _gift(2, "999.99"),
            _gift(3, "1200"), _gift(3, "-200"),
            _gift(4, "1200"), _gift(4, "-200.01"),
            _gift(5, "1000", status=2),
            _gift(6, "1000", day=datetime(2000, 7, 15, 11, 59)),
            _gift(7, "1000", day=datetime(2000, 7, 15, 12)),
            _gift(None, "5000"),
        ],
    )
    assert values(rules.major_donor(t, AS_OF), "contact_id") == [1, 3, 7]
    assert values(rules.major_donor(t, AS_OF, status=None), "contact_id") == [1, 3, 5, 7]


def test_fanout_counts_gifts_per_membership(crm, spark):
    t = crm(
        option_group=OPTION_GROUPS,
        option_value=STATUS,
        contribution=[_gift(1, "300"), _gift(1, "300"), _gift(2, "600"), _gift(3, "2000")],
    )
    base = local_rows(spark, [(1, 11), (1, 12), (2, 21)], "contact_id bigint, membership_id bigint")
    assert values(rules.major_donor_fanout(t, base, AS_OF), "contact_id") == [1]


# Keys and row counts.


MAILABLE = {"do_not_email": 0, "is_opt_out": 0, "is_deceased": 0, "is_deleted": 0, "contact_type": "Individual"}


def _mailing_tables(crm, **more):
    contact = [{"id": 1, "hash": "h", "external_identifier": "X-1", **MAILABLE}]
    email = [{"contact_id": 1, "email": "a@example.org", "is_primary": 1}]
    return crm(**({"contact": contact, "email": email, "option_group": OPTION_GROUPS} | more))


def test_mailing_fails_on_second_primary_address(crm):
    assert exports.export_mailing(_mailing_tables(crm)).count() == 1
    doubled = _mailing_tables(crm, address=[_home(1), _home(1, id=11)])
    with pytest.raises(Exception, match="duplicate key contact_id=1"):
        exports.export_mailing(doubled).collect()
    found = updates.duplicate_keys(exports.export_mailing(doubled, checked=False), "contact_id").collect()
    assert [tuple(r) for r in found] == [(1, 2)]


def test_mailing_fails_on_second_statistics_row(crm):
    stats = [{"entity_id": 10, "rts_counter": 0}, {"entity_id": 10, "rts_counter": 1}]
    with pytest.raises(Exception, match="duplicate key contact_id=1"):
        exports.export_mailing(_mailing_tables(crm, address=[_home(1)], address_statistics=stats)).collect()


def test_mailing_drops_missing_identifier_and_email(crm):
    contact = [
        {"id": 1, "external_identifier": None, **MAILABLE},
        {"id": 2, "external_identifier": "X-2", **MAILABLE},
        {"id": 3, "external_identifier": "X-3", **MAILABLE},
        {"id": 4, "external_identifier": "X-4", **MAILABLE | {"is_opt_out": None}},
    ]
    email = [{"contact_id": n, "email": "e", "is_primary": 1} for n in (1, 3, 4)]
    email += [{"contact_id": 2, "email": None, "is_primary": 1}, {"contact_id": 2, "email": "b", "is_primary": 0}]
    assert values(exports.export_mailing(_mailing_tables(crm, contact=contact, email=email)), "contact_id") == [3]


def test_group_status_is_shown_as_it_is(crm):
    t = _mailing_tables(
        crm,
        group=[{"id": 1, "title": "Community NL"}, {"id": 2, "title": "Donation Info"}],
        group_contact=[{"contact_id": 1, "group_id": 1, "status": "Removed"}],
    )
    row = exports.export_mailing(t).first()
    assert (row.Community_NL, row.Donation_Info) == ("Removed", None)


def test_petitions_take_every_role_and_need_a_campaign(crm):
    t = _mailing_tables(
        crm,
        option_value=[option("activity_type", "32", "Petition"), option("activity_type", "2", "Call")],
        survey=[
            {"id": 1, "title": "P1", "campaign_id": 5, "activity_type_id": 32},
            {"id": 2, "title": "P2", "campaign_id": None, "activity_type_id": 32},
            {"id": 3, "title": "P3", "campaign_id": 5, "activity_type_id": 2},
        ],
        campaign=[{"id": 5, "title": "C5"}],
        activity=[
            {"id": 100, "activity_type_id": 32, "source_record_id": 1},
            {"id": 90, "activity_type_id": 32, "source_record_id": 2},
            {"id": 80, "activity_type_id": 32, "source_record_id": 3},
            {"id": 70, "activity_type_id": 2, "source_record_id": 1},
        ],
        activity_contact=[{"activity_id": a, "contact_id": 1, "record_type_id": 2} for a in (100, 90, 80, 70)],
    )
    row = exports.export_mailing(t).first()
    assert (row.Petition, row.Campaign_Topic) == ("P1", "C5")


def _welcome_email_tables(crm, emails):
    return crm(
        contact=[{"id": 1, "hash": "h", **MAILABLE}],
        email=[{"contact_id": 1, "email": e, "is_primary": 1} for e in emails],
        option_group=OPTION_GROUPS,
        option_value=[option("payment_instrument", "1", "RCUR")],
        membership=[{"id": 7, "contact_id": 1, "join_date": date(2001, 7, 1), "status_id": 1}],
        membership_status=[{"id": 1, "label": "Current"}],
        value_membership_payment=[{"entity_id": 7, "payment_instrument": 1}],
    )


def test_email_export_merges_equal_and_refuses_different_emails(crm):
    assert exports.export_welcome_email(_welcome_email_tables(crm, ["a", "a"]), AS_OF, None).count() == 1
    with pytest.raises(Exception, match="duplicate key contact_id=1"):
        exports.export_welcome_email(_welcome_email_tables(crm, ["a", "b"]), AS_OF, None).collect()


def test_email_export_refuses_different_emails_of_any_contact(crm):
    t = _welcome_email_tables(crm, ["a"])
    other = crm(
        contact=[{"id": 2, "hash": "x", **MAILABLE}],
        email=[{"contact_id": 2, "email": e, "is_primary": 1} for e in "ab"],
    )
    t |= {name: t[name].unionByName(other[name]) for name in ("contact", "email")}
    with pytest.raises(Exception, match="duplicate key contact_id=2"):
        exports.export_welcome_email(t, AS_OF, None).collect()
    assert exports.export_welcome_email(t, AS_OF, None, checked=False).count() == 1


def test_email_export_floor_day(crm):
    t = _welcome_email_tables(crm, ["a"])
    assert exports.export_welcome_email(t, AS_OF).count() == 0
    assert exports.export_welcome_email(t, AS_OF, "2001-07-01").count() == 1


def _post_tables(crm, **more):
    given = {
        "contact": [_person(1)],
        "address": [_home(1)],
        "country": [{"id": 1, "iso_code": "AT"}, {"id": 2, "iso_code": "DE"}],
        "campaign": [{"id": 7, "external_identifier": "AKTION-7767"}],
        "option_group": OPTION_GROUPS,
        "option_value": [option("payment_instrument", "1", "RCUR")],
        "membership": [
            {"id": 7, "contact_id": 1, "join_date": date(2001, 7, 1), "status_id": 1, "membership_type_id": 1},
            {"id": 8, "contact_id": 1, "join_date": date(2001, 7, 2), "status_id": 1, "membership_type_id": 2},
            {"id": 9, "contact_id": 2, "join_date": date(2001, 7, 2), "status_id": 1, "membership_type_id": 9},
        ],
        "membership_status": [{"id": 1, "label": "Current"}],
        "membership_type": [{"id": 1, "name": "Meer"}, {"id": 2, "name": "Baum"}],
        "value_membership_payment": [{"entity_id": n, "payment_instrument": 1} for n in (7, 8, 9)],
    }
    return crm(**(given | more))


def test_post_export_rows(crm):
    rows = {r.contact_id: r for r in exports.export_welcome_post(_post_tables(crm), AS_OF).collect()}
    assert (rows[1].nachname, rows[1].kundennummer, rows[1].vertragstyp) == ("B", "00007C000000001", "Baum, Meer")
    # Not in the contact table: nothing to disqualify it by, and no known kind of membership.
    assert (rows[2].nachname, rows[2].vertragstyp) == (None, None)


def test_post_export_multiplies_lines_and_judges_all_of_them(crm):
    two = _post_tables(crm, address=[_home(1), _home(1, id=11, street_address="other")])
    assert values(exports.export_welcome_post(two, AS_OF).filter("contact_id = 1"), "strasse") == ["other", "s"]
    one_abroad = _post_tables(crm, address=[_home(1), _home(1, id=11, country_id=2)])
    assert exports.export_welcome_post(one_abroad, AS_OF).filter("contact_id = 1").count() == 0


def test_insert_new_skips_present_and_repeated(spark):
    schema = "activity_id bigint, contact_id bigint"
    target = local_rows(spark, [(1, 1)], schema)
    rows = local_rows(spark, [(1, 1), (1, 2), (1, 2), (2, 1)], schema)
    added = updates.insert_new(target, rows, ["activity_id", "contact_id"])
    assert sorted(tuple(r) for r in added.collect()) == [(1, 2), (2, 1)]


# Calls.


def _call_tables(crm, **more):
    callable_ = {"do_not_phone": 0, "is_deceased": 0, "is_deleted": 0}
    given = {
        "contact": [{"id": n, **callable_} for n in (1, 2)] + [{"id": 3, **callable_ | {"do_not_phone": 1}}],
        "phone": [{"contact_id": n, "phone": "1", "is_primary": 0} for n in (1, 3)]
        + [{"contact_id": 1, "phone": "2", "is_primary": 1}, {"contact_id": 2, "phone": None, "is_primary": 1}],
        "option_group": OPTION_GROUPS,
        "option_value": [
            option("payment_instrument", "1", "RCUR"),
            option("contribution_status", "1", "Completed"),
            option("contribution_status", "3", "Cancelled"),
            option("activity_status", "2", "Completed"),
        ],
        "membership": [
            {"id": 10 * n, "contact_id": n, "join_date": date(2001, 7, 10), "status_id": 1, "campaign_id": 5}
            for n in (1, 2, 3)
        ],
        "membership_status": [{"id": 1, "label": "Current"}],
        "value_membership_payment": [
            {"entity_id": 10 * n, "payment_instrument": 1, "membership_recurring_contribution": n} for n in (1, 2, 3)
        ],
        "contribution_recur": [{"id": n, "next_sched_contribution_date": datetime(2001, 8, 1)} for n in (1, 2, 3)],
        "campaign": [{"id": 5, "name": "x", "parent_id": 6}, {"id": 6, "name": "DD"}],
    }
    return crm(**(given | more))


def test_call_export_needs_any_phone(crm):
    assert values(exports.export_welcome_call(_call_tables(crm), AS_OF), "contact_id") == [1]
    assert values(exports.call_base(_call_tables(crm), AS_OF), "membership_id") == [10]


def test_call_export_includes_future_and_excludes_quiet_days(crm):
    future = [{"id": 10, "contact_id": 1, "join_date": date(2002, 1, 1), "status_id": 1, "campaign_id": 5}]
    assert exports.export_welcome_call(_call_tables(crm, membership=future), AS_OF).count() == 1
    assert exports.export_welcome_call(_call_tables(crm), datetime(2001, 7, 16, 12)).count() == 0


def test_call_export_judges_memberships_one_by_one(crm):
    two = [
        {"id": m, "contact_id": 1, "join_date": date(2001, 7, 10), "status_id": 1, "campaign_id": 5} for m in (10, 11)
    ]
    payment = [{"entity_id": m, "payment_instrument": 1, "membership_recurring_contribution": 1} for m in (10, 11)]
    gifts = [_gift(1, "5", status=3) | {"id": 900}]
    failed = {"membership_payment": [{"membership_id": 10, "contribution_id": 900}], "contribution": gifts}
    t = _call_tables(crm, membership=two, value_membership_payment=payment, **failed)
    assert exports.export_welcome_call(t, AS_OF).count() == 1
    both = failed["membership_payment"] + [{"membership_id": 11, "contribution_id": 900}]
    t = _call_tables(crm, membership=two, value_membership_payment=payment, contribution=gifts, membership_payment=both)
    assert exports.export_welcome_call(t, AS_OF).count() == 0


def test_call_export_fanout_can_be_switched_off(crm):
    two = [
        {"id": m, "contact_id": 1, "join_date": date(2001, 7, 10), "status_id": 1, "campaign_id": 5} for m in (10, 11)
    ]
    payment = [{"entity_id": m, "payment_instrument": 1, "membership_recurring_contribution": 1} for m in (10, 11)]
    t = _call_tables(crm, membership=two, value_membership_payment=payment, contribution=[_gift(1, "600")])
    assert exports.export_welcome_call(t, AS_OF).count() == 0
    assert exports.export_welcome_call(t, AS_OF, fanout=False).count() == 1


# Orders.


SETTING = '{"default":{"file":"d","remote":"x/"},"1":{"file":"one","remote":"y/"}}'


def test_routes_need_a_default(spark):
    assert values(routes(spark, SETTING), "route_key") == ["1", "default"]
    with pytest.raises(ValueError, match="default"):
        routes(spark, '{"0":{"file":"d","remote":"x/"}}')


def test_route_key(spark):
    rows = local_rows(spark, [(None,), ("9",), ("1",)], "order_type string")
    routed = exports.with_route(rows, routes(spark, SETTING))
    assert {r.order_type: r.route_key for r in routed.collect()} == {None: "default", "9": "default", "1": "1"}


def _order(number, contact=1, **changes):
    order = {
        "id": number, "activity_type_id": 33, "source_contact_id": contact, "payment_received": 1,
        "order_exported": 0, "activity_date_time": datetime(2001, 7, 1, 8, 30),
    }
    return order | changes


def _order_tables(crm, orders, **more):
    given = {
        "webshop_order": orders,
        "contact": [_person(1, organization_name="Firm"), _person(2)],
        "option_group": OPTION_GROUPS,
        "option_value": [
            option("activity_type", "33", "Webshop Order"),
            option("activity_type", "2", "Call"),
            option("order_type", "1", "One"),
        ],
    }
    return crm(**(given | more))


def test_pending_orders_ignore_null_flags(crm):
    t = _order_tables(
        crm,
        [
            _order(1), _order(2, payment_received=None), _order(3, order_exported=None), _order(4, order_exported=1),
            _order(5, activity_type_id=2), _order(6, payment_received=0),
        ],
    )
    assert values(pending_orders(t), "id") == [1]


def test_order_without_contact_stops_the_export(crm, spark):
    good = _order_tables(crm, [_order(1, order_type="1")])
    row = exports.export_orders(good, routes(spark, SETTING)).first()
    assert (row.item, row.co, row.date_of_order, row.route_key) == ("One", "Firm", "2001-07-01 08:30:00", "1")
    for contact in (99, None):
        with pytest.raises(Exception, match="order without contact: 2"):
            exports.export_orders(_order_tables(crm, [_order(1), _order(2, contact)]), routes(spark, SETTING)).collect()


def test_order_contact_must_be_one_row(crm, spark):
    doubled = _order_tables(crm, [_order(1)], address=[_home(1), _home(1, id=11), _home(2), _home(2, id=21)])
    with pytest.raises(Exception, match="duplicate key id=1"):
        exports.export_orders(doubled, routes(spark, SETTING)).collect()
    # Contact 2 has two addresses as well, but no order.
    other = _order_tables(crm, [_order(1)], address=[_home(1), _home(2), _home(2, id=21)])
    assert exports.export_orders(other, routes(spark, SETTING)).count() == 1


def test_rename_custom_fields(spark):
    rows = local_rows(spark, [(1, 2)], "custom_7 int, custom_8 int")
    assert rename_custom(rows, {"a": 7, "b": 8}).columns == ["a", "b"]
    with pytest.raises(ValueError, match="c"):
        rename_custom(rows, {"c": 9})


def test_project_refuses_a_missing_column(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        exports.project(spark.range(1), ["id", "missing"])


def test_primary_join_keeps_rows_without_detail(crm, spark):
    t = crm(email=[{"contact_id": 1, "email": "a", "is_primary": 0}])
    rows = local_rows(spark, [(1,), (2,)], "contact_id bigint")
    assert joins.join_primary(rows, t["email"], ["email"]).filter("email IS NULL").count() == 2
