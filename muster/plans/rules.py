"""Suppression and keep rules: each maps the tables to a distinct set of contact or membership ids.

Rules over large tables take an optional set of ids: they then need to be right about these only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.operators.aggregates import sum_at_least, sum_by
from muster.operators.filters import (
    floor_date,
    link_scope,
    postal_reasons,
    since,
    since_condition,
    with_role,
)
from muster.operators.joins import join_primary, membership_contributions, with_recurring
from muster.operators.lookups import (
    Tables,
    has_option,
    has_value,
    in_campaigns,
    in_title_or_id,
    join_dim,
    lookup_id,
    mark_campaigns,
    option_in,
    under_root,
)
from muster.operators.sets import within

# Names the rules look for.
TAGS_POST = ("inaktiv", "VIP", "Firma", "Schule")
TAGS_MAIL_AND_CALL = ("inaktiv", "VIP")
LEGACY_GROUP = "Erblasser"
ACTIVE_STATUSES = ("Current", "Paused")
DIRECT_DEBIT = ("RCUR", "FRST")
MAILING_CAMPAIGN = "AKTION-7767"
CALL_CAMPAIGN, CALL_CAMPAIGN_TITLE = "AKTION-7571", "Welcome Calls"
PHONE_ROOT, STREET_ROOT = "TM", "DD"
MAJOR_DONOR_SUM = 1000
FAILED, PAID = ("Cancelled", "Refunded"), ("Completed",)


def tagged(t: Tables, names: Sequence[str]) -> DataFrame:
    """Contacts that carry one of the tags."""
    links = has_value(link_scope(t["entity_tag"]), t["tag"], "tag_id", "name", names)
    return links.select(F.col("entity_id").alias("contact_id")).distinct()


def group_member(t: Tables, title: str = LEGACY_GROUP) -> DataFrame:
    """Contacts with any status in the group, 'Removed' included."""
    return has_value(t["group_contact"], t["group"], "group_id", "title", [title]).select("contact_id").distinct()


def _year_of_gifts(t: Tables, as_of: datetime, status: str | None, ids: DataFrame | None) -> DataFrame:
    gifts = since(t["contribution"], "receive_date", as_of, (1, "YEAR"))
    if status is not None:
        gifts = has_option(gifts, t, "contribution_status_id", "contribution_status", [status])
    return within(gifts.filter(F.col("contact_id").isNotNull()), ids, "contact_id")


def major_donor(
    t: Tables,
    as_of: datetime,
    threshold: float = MAJOR_DONOR_SUM,
    status: str | None = "Completed",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Contacts whose gifts within a year reach the threshold; ``status=None`` counts gifts of any status."""
    gifts = _year_of_gifts(t, as_of, status, ids)
    return sum_at_least(gifts, "contact_id", "total_amount", threshold).select("contact_id")


def major_donor_fanout(
    t: Tables,
    base: DataFrame,
    as_of: datetime,
    threshold: float = MAJOR_DONOR_SUM,
    status: str | None = "Completed",
    ids: DataFrame | None = None,
) -> DataFrame:
    """As ``major_donor``, with each contact's sum counted once per row the contact has in ``base``.

    Both sides are grouped by contact before they meet, so the repeated gifts are multiplied, not produced.
    """
    sums = sum_by(_year_of_gifts(t, as_of, status, ids), "contact_id", "total_amount")
    copies = base.groupBy("contact_id").agg(F.count(F.lit(1)).alias("_copies"))
    reached = F.col("total") * F.col("_copies") >= threshold
    return sums.join(copies, "contact_id").filter(reached).select("contact_id")


def activity_targets(t: Tables, activities: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Contacts that are a target of one of the activities (activity_id).

    The links stay the streamed side of a semi join. One mass mailing links a large part of all contacts; both
    inputs come straight from their shuffle, so adaptive execution can split that activity's links.
    """
    links = within(with_role(t["activity_contact"]).select("activity_id", "contact_id"), ids, "contact_id")
    return links.join(activities, "activity_id", "left_semi").select("contact_id").distinct()


def mailing_activities(t: Tables, as_of: datetime, ext_id: str = MAILING_CAMPAIGN) -> DataFrame:
    recent = since(t["activity"], "activity_date_time", as_of, (6, "MONTH"))
    sent = has_option(in_campaigns(recent, t["campaign"], ext_id), t, "status_id", "activity_status", ["Completed"])
    return sent.select(F.col("id").alias("activity_id"))


def call_activities(t: Tables, ext_id: str = CALL_CAMPAIGN, title: str = CALL_CAMPAIGN_TITLE) -> DataFrame:
    calls = in_campaigns(t["activity"], t["campaign"], ext_id, title)
    planned = has_option(calls, t, "status_id", "activity_status", ["Completed", "Scheduled"])
    return planned.select(F.col("id").alias("activity_id"))


def tree_activities(t: Tables, as_of: datetime, root: str = PHONE_ROOT) -> DataFrame:
    recent = since(t["activity"], "activity_date_time", as_of, (3, "MONTH"))
    done = has_option(recent, t, "status_id", "activity_status", ["Completed"])
    return under_root(done, t["campaign"], root).select(F.col("id").alias("activity_id"))


def call_history(
    t: Tables,
    as_of: datetime,
    ext_id: str = CALL_CAMPAIGN,
    title: str = CALL_CAMPAIGN_TITLE,
    root: str = PHONE_ROOT,
) -> DataFrame:
    """``call_activities`` and ``tree_activities`` together, in one pass over the activities."""
    marked = mark_campaigns(t["campaign"], root)
    wanted = in_title_or_id(ext_id, title)
    campaigns = marked.filter(F.col("under_root") | wanted).select(
        F.col("id").alias("campaign_id"), "under_root", F.coalesce(wanted, F.lit(False)).alias("_calls")
    )
    recent = since_condition(t["activity"], "activity_date_time", as_of, (3, "MONTH"))
    done = option_in(t, "status_id", "activity_status", ["Completed"])
    planned = option_in(t, "status_id", "activity_status", ["Completed", "Scheduled"])
    known = t["activity"].join(campaigns, "campaign_id")
    kept = known.filter((F.col("_calls") & planned) | (F.col("under_root") & done & recent))
    return kept.select(F.col("id").alias("activity_id"))


def recent_mailing(
    t: Tables, as_of: datetime, ext_id: str = MAILING_CAMPAIGN, ids: DataFrame | None = None
) -> DataFrame:
    """Contacts reached by the campaign within six months."""
    return activity_targets(t, mailing_activities(t, as_of, ext_id), ids)


def previous_call(t: Tables, ext_id: str = CALL_CAMPAIGN, title: str = CALL_CAMPAIGN_TITLE) -> DataFrame:
    """Contacts with a done or planned call of the call campaigns, at any time."""
    return activity_targets(t, call_activities(t, ext_id, title))


def campaign_tree_contact(t: Tables, as_of: datetime, root: str = PHONE_ROOT) -> DataFrame:
    """Contacts of a completed activity within three months somewhere under the root campaign."""
    return activity_targets(t, tree_activities(t, as_of, root))


def membership_failed(t: Tables, statuses: Sequence[str] = FAILED, ids: DataFrame | None = None) -> DataFrame:
    """Memberships (of ``ids``: membership_id) with a failed contribution."""
    links = within(t["membership_payment"], ids, "membership_id")
    return membership_contributions(t, statuses, links).select("membership_id").distinct()


def membership_paid(t: Tables) -> DataFrame:
    """Memberships that already have a completed contribution."""
    return membership_failed(t, PAID)


def membership_settled(t: Tables, ids: DataFrame | None = None) -> DataFrame:
    """Memberships of either kind, in one pass over links and contributions."""
    return membership_failed(t, [*FAILED, *PAID], ids)


def postal_profile(t: Tables, contact: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``contact`` (contact_id, ...) with primary address, returned letters and country code."""
    primary = within(t["address"].filter(F.col("is_primary") == 1), ids, "contact_id")
    address = join_dim(primary, t["address_statistics"], "id", ["rts_counter"], key="entity_id")
    address = join_dim(address, t["country"], "country_id", ["iso_code"])
    return join_primary(contact, address, ["street_address", "postal_code", "city", "rts_counter", "iso_code"])


def postal_ineligible(t: Tables) -> DataFrame:
    """Contacts without a clean postal address in the country."""
    contact = t["contact"].withColumnRenamed("id", "contact_id")
    return postal_profile(t, contact).filter(postal_reasons()).select("contact_id").distinct()


def active_memberships(t: Tables, memberships: DataFrame | None = None) -> DataFrame:
    """Memberships (all, or the given ones) that run or pause."""
    memberships = t["membership"] if memberships is None else memberships
    return has_value(memberships, t["membership_status"], "status_id", "label", ACTIVE_STATUSES)


def paying_memberships(t: Tables, memberships: DataFrame | None = None) -> DataFrame:
    """Memberships (all, or the given ones) that are active and paid by direct debit."""
    active = active_memberships(t, memberships)
    payment = has_option(
        t["value_membership_payment"], t, "payment_instrument", "payment_instrument", DIRECT_DEBIT, by="name"
    ).select(F.col("entity_id").alias("id"), "membership_recurring_contribution")
    return active.join(payment, "id")


def joined_recently(t: Tables, as_of: datetime) -> DataFrame:
    """Memberships joined from six months to two days ago."""
    return since(t["membership"], "join_date", as_of, (6, "MONTH"), until=(2, "DAY"))


def new_direct_debits(t: Tables, as_of: datetime) -> DataFrame:
    """Those of them that are active and paid by direct debit."""
    return paying_memberships(t, joined_recently(t, as_of))


def recent_direct_debit(t: Tables, as_of: datetime, floor: str | None = None) -> DataFrame:
    """Their contacts; ``floor`` is an additional first join day."""
    joined = new_direct_debits(t, as_of)
    if floor is not None:
        joined = floor_date(joined, "join_date", floor)
    return joined.filter(F.col("contact_id").isNotNull()).select("contact_id").distinct()


def recruited(
    t: Tables, as_of: datetime, root: str = STREET_ROOT, memberships: DataFrame | None = None
) -> DataFrame:
    """Active direct debit memberships with a charge still to come, recruited under the root campaign."""
    under = under_root(t["membership"] if memberships is None else memberships, t["campaign"], root)
    due = with_recurring(active_memberships(t, under), t, as_of)
    return has_option(due, t, "payment_instrument", "payment_instrument", DIRECT_DEBIT, by="name")


def recruited_membership(t: Tables, as_of: datetime, root: str = STREET_ROOT) -> DataFrame:
    return recruited(t, as_of, root).select(F.col("id").alias("membership_id")).distinct()


def campaign_id(t: Tables, ext_id: str):
    """The campaign's id as a scalar."""
    return lookup_id(t["campaign"], F.col("external_identifier") == ext_id)
