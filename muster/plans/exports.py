"""The five exports as DataFrames: base population, rules, enrichment, projection to fixed columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions.text import customer_no_cut, customer_no_full, name_by_type, typed_null
from muster.operators.aggregates import concat_distinct, distinct_rows
from muster.operators.filters import (
    filter_type,
    keep_unflagged,
    not_prefixed,
    postal_reasons,
    require,
    run_day_gate,
    since,
)
from muster.operators.joins import (
    attach,
    join_primary,
    order_contacts,
    petition_texts,
    with_contact,
    with_phone,
)
from muster.operators.lookups import Tables, join_dim, option_label
from muster.operators.sets import keep, not_in, suppress, suppress_where, union_ids, within
from muster.operators.updates import add_group_status, unique_or_fail
from muster.plans import rules
from muster.sources.tables import pending_orders

# The columns of each file, in file order.
MAILING_KEYS = [
    "Contact_Hash", "Email", "Salutation", "Firstname", "Lastname", "Birthday", "Title", "ZIP", "City", "Country",
    "Address", "contact_id", "Telephone", "PersonID_IMB", "Package_id", "Segment_id", "Community_NL",
    "Donation_Info", "Campaign_Topic", "Petition",
]
POST_KEYS = [
    "contact_id", "titel", "anrede", "vorname", "nachname", "co", "strasse", "plz", "ort", "postfach", "land",
    "kundennummer", "vertragstyp",
]
EMAIL_KEYS = ["Contact_Hash", "Email", "contact_id"]
CALL_KEYS = ["contact_id"]
ORDER_KEYS = [
    "id", "titel", "anrede", "vorname", "nachname", "co", "strasse", "state", "ort", "postfach", "land",
    "kundennummer", "item", "anzahl_items", "tshirt_type", "tshirt_size", "date_of_order", "activity_description",
    "contribution_id", "membership_id", "multi_purpose", "order_type", "email",
]
# The groups whose status the mailing file shows, by column.
STATUS_GROUPS = {"Community_NL": "Community NL", "Donation_Info": "Donation Info"}
# Fixed value: members who joined before this day get no welcome e-mail.
EMAIL_FLOOR = "2017-07-12"


def project(df: DataFrame, keys: list[str]) -> DataFrame:
    """The file's columns in the file's order and spelling, as plain texts; a missing one is an error."""
    texts = {field.name for field in df.schema if isinstance(field.dataType, T.StringType)}
    return df.select(*[F.col(key).cast("string").alias(key) if key in texts else key for key in keys])


def mailing_people(t: Tables) -> DataFrame:
    """E-mailable persons by what their contact row says."""
    people = filter_type(
        keep_unflagged(t["contact"], ["do_not_email", "is_opt_out", "is_deceased", "is_deleted"]), "Individual"
    ).withColumnRenamed("id", "contact_id")
    return not_prefixed(people, "external_identifier", "USER-")


def mailing_base(t: Tables) -> DataFrame:
    """E-mailable persons without a web login, with primary address, e-mail and phone."""
    people = not_in(mailing_people(t), t["uf_match"], "contact_id")
    reachable = require(join_primary(people, t["email"], ["email AS Email"]), "Email")
    # The statistics bring no column, but a repeated entry repeats the contact, which the key check must see.
    address = join_dim(
        join_dim(t["address"], t["address_statistics"], "id", [], key="entity_id"),
        t["country"],
        "country_id",
        ["iso_code"],
    )
    place = ["postal_code AS ZIP", "city AS City", "iso_code AS Country", "street_address AS Address"]
    located = join_primary(reachable, address, place)
    return option_label(
        join_primary(located, t["phone"], ["phone AS Telephone"]), t, "prefix_id", "individual_prefix", out="Salutation"
    )


def export_mailing(t: Tables, checked: bool = True) -> DataFrame:
    """Every e-mailable person with address, group status and signed petitions; one row per contact."""
    rows = add_group_status(mailing_base(t), t, STATUS_GROUPS)
    # Links are cut to the audience, by contact rows alone, before anything is grouped.
    signed = petition_texts(t, mailing_people(t).select("contact_id"))
    rows = attach(rows, signed, "contact_id").select(
        F.col("hash").alias("Contact_Hash"),
        "Email",
        "Salutation",
        F.col("first_name").alias("Firstname"),
        F.col("last_name").alias("Lastname"),
        F.col("birth_date").alias("Birthday"),
        F.col("formal_title").alias("Title"),
        "ZIP", "City", "Country", "Address", "contact_id", "Telephone",
        F.col("external_identifier").alias("PersonID_IMB"),
        typed_null("int").alias("Package_id"),
        typed_null("int").alias("Segment_id"),
        "Community_NL",
        "Donation_Info",
        F.col("campaign_topic").alias("Campaign_Topic"),
        F.col("petition").alias("Petition"),
    )
    return project(unique_or_fail(rows, "contact_id") if checked else rows, MAILING_KEYS)


def membership_kinds(t: Tables, as_of: datetime) -> DataFrame:
    """The contacts of new direct debit memberships, each with the names of the kinds of these memberships."""
    kinds = t["membership_type"].select(
        F.col("id").alias("membership_type_id"), F.col("name").alias("membership_type")
    )
    named = rules.new_direct_debits(t, as_of).join(kinds, "membership_type_id", "left")
    return concat_distinct(require(named, "contact_id"), "contact_id", "membership_type")


def _owners(memberships: DataFrame) -> DataFrame:
    """The contacts of memberships: the only ones that rules are asked about."""
    return memberships.filter(F.col("contact_id").isNotNull()).select("contact_id").distinct()


def export_welcome_post(t: Tables, as_of: datetime, campaign: str = rules.MAILING_CAMPAIGN) -> DataFrame:
    """New direct debit members with a clean address; a second primary address gives a second line.

    Address rule and address columns come from the same joined rows. A contact missing in the contact table
    has no address to be judged by and stays.
    """
    new = _owners(rules.joined_recently(t, as_of))
    audience = suppress(
        membership_kinds(t, as_of),
        [
            rules.tagged(t, rules.TAGS_POST),
            rules.group_member(t),
            rules.major_donor(t, as_of, ids=new),
            rules.recent_mailing(t, as_of, campaign, new),
        ],
        "contact_id",
    )
    contact = t["contact"].withColumnRenamed("id", "contact_id").withColumn("_known", F.lit(True))
    rows = rules.postal_profile(t, audience.join(within(contact, new, "contact_id"), "contact_id", "left"), new)
    rows = suppress_where(rows, F.col("_known") & postal_reasons(), "contact_id")
    rows = option_label(rows, t, "prefix_id", "individual_prefix", out="anrede").select(
        "contact_id",
        F.col("formal_title").alias("titel"),
        "anrede",
        F.col("first_name").alias("vorname"),
        name_by_type().alias("nachname"),
        typed_null("string").alias("co"),
        F.col("street_address").alias("strasse"),
        F.col("postal_code").alias("plz"),
        F.col("city").alias("ort"),
        typed_null("string").alias("postfach"),
        F.col("iso_code").alias("land"),
        customer_no_cut(rules.campaign_id(t, campaign), F.col("contact_id")).alias("kundennummer"),
        F.col("membership_type").alias("vertragstyp"),
    )
    return project(rows, POST_KEYS)


def welcome_email_base(t: Tables) -> DataFrame:
    """E-mailable contacts; the same e-mail twice is one row."""
    people = keep_unflagged(t["contact"], ["is_deceased", "is_deleted", "do_not_email", "is_opt_out"]).select(
        F.col("id").alias("contact_id"), F.col("hash").alias("Contact_Hash")
    )
    return require(join_primary(people, t["email"], ["email AS Email"]), "Email")


def export_welcome_email(
    t: Tables,
    as_of: datetime,
    floor: str | None = EMAIL_FLOOR,
    checked: bool = True,
) -> DataFrame:
    """E-mailable contacts with a new direct debit membership.

    Two different primary e-mails of any e-mailable contact, exported or not, fail the export. That check reads
    all contacts; without it only new members are read.
    """
    new = _owners(rules.joined_recently(t, as_of))
    base = welcome_email_base(t)
    if checked:
        base = unique_or_fail(distinct_rows(base, EMAIL_KEYS), "contact_id")
    else:
        base = distinct_rows(within(base, new, "contact_id"), EMAIL_KEYS)
    left = suppress(
        keep(base, rules.recent_direct_debit(t, as_of, floor), "contact_id"),
        [
            rules.tagged(t, rules.TAGS_MAIL_AND_CALL),
            rules.group_member(t),
            rules.major_donor(t, as_of, status=None, ids=new),
        ],
        "contact_id",
    )
    return project(left, EMAIL_KEYS)


def callable_contacts(t: Tables, ids: DataFrame | None = None) -> DataFrame:
    """Contacts (of ``ids``) that may be phoned and have any number."""
    contact = within(t["contact"].withColumnRenamed("id", "contact_id"), ids, "contact_id")
    phone = within(t["phone"], ids, "contact_id")
    return with_phone(keep_unflagged(contact, ["is_deceased", "is_deleted", "do_not_phone"]).select("contact_id"), phone)


def last_month_memberships(t: Tables, as_of: datetime) -> DataFrame:
    """Memberships of the last month, future ones included; none on a quiet day."""
    return run_day_gate(since(t["membership"], "join_date", as_of, (1, "MONTH")), as_of)


def call_base(t: Tables, as_of: datetime) -> DataFrame:
    """(contact_id, membership_id): callable contacts with a membership of the last month."""
    pairs = last_month_memberships(t, as_of).select("contact_id", F.col("id").alias("membership_id"))
    return keep(pairs, callable_contacts(t), "contact_id")


def call_suppressed(
    t: Tables, as_of: datetime, fanout: bool = True, ids: DataFrame | None = None
) -> DataFrame:
    """Contacts that get no call. The two contact-history rules read activities and links once."""
    if fanout:
        # Counted before any other rule takes effect.
        copies = last_month_memberships(t, as_of).select("contact_id")
        donors = rules.major_donor_fanout(t, copies, as_of, ids=ids)
    else:
        donors = rules.major_donor(t, as_of, ids=ids)
    reached = rules.activity_targets(t, rules.call_history(t, as_of), ids)
    return union_ids(rules.tagged(t, rules.TAGS_MAIL_AND_CALL), donors, reached)


def export_welcome_call(t: Tables, as_of: datetime, fanout: bool = True) -> DataFrame:
    """Contacts to be called about a brand-new membership.

    A contact stays when one of its memberships survives the membership rules, so these run first, per
    membership; what is left is one row per contact, and all contact rules are semi and anti joins on that.
    """
    recent = last_month_memberships(t, as_of)
    new = _owners(recent)
    kept = rules.recruited(t, as_of, memberships=recent)
    pairs = kept.select("contact_id", F.col("id").alias("membership_id"))
    settled = rules.membership_settled(t, recent.select(F.col("id").alias("membership_id")))
    unpaid = suppress(pairs, [settled], "membership_id")
    contacts = keep(unpaid.select("contact_id").distinct(), callable_contacts(t, new), "contact_id")
    return project(suppress(contacts, [call_suppressed(t, as_of, fanout, new)], "contact_id"), CALL_KEYS)


def order_lines(t: Tables, orders: DataFrame) -> DataFrame:
    """Orders as file lines, all file columns plus source_contact_id."""
    rows = with_contact(orders, order_contacts(t, orders))
    return option_label(rows, t, "order_type", "order_type", out="item").select(
        "id",
        F.col("formal_title").alias("titel"),
        F.col("individual_prefix").alias("anrede"),
        F.col("first_name").alias("vorname"),
        F.col("last_name").alias("nachname"),
        F.col("current_employer").alias("co"),
        F.col("street_address").alias("strasse"),
        F.col("state_province").alias("state"),
        F.col("city").alias("ort"),
        # This column carries the postal code in the order file.
        F.col("postal_code").alias("postfach"),
        F.col("country").alias("land"),
        customer_no_full(F.col("campaign_id"), F.col("source_contact_id")).alias("kundennummer"),
        "item",
        F.col("order_count").alias("anzahl_items"),
        F.col("shirt_type").alias("tshirt_type"),
        F.col("shirt_size").alias("tshirt_size"),
        F.date_format("activity_date_time", "yyyy-MM-dd HH:mm:ss").alias("date_of_order"),
        F.col("details").alias("activity_description"),
        F.col("linked_contribution").alias("contribution_id"),
        F.col("linked_membership").alias("membership_id"),
        "multi_purpose",
        "order_type",
        "email",
        "source_contact_id",
    )


def with_route(df: DataFrame, routes: DataFrame, code_column: str = "order_type") -> DataFrame:
    """Add ``route_key``: the order type's own route, or ``default``."""
    own = routes.select(F.col("route_key").alias("_route"))
    key = F.coalesce(F.col("_route"), F.lit("default")).alias("route_key")
    return df.join(own, F.col(code_column).cast("string") == F.col("_route"), "left").select(*df.columns, key)


def export_orders(t: Tables, routes: DataFrame) -> DataFrame:
    """Paid, not yet exported orders with their contact and their route."""
    return project(with_route(order_lines(t, pending_orders(t)), routes), [*ORDER_KEYS, "route_key"])
