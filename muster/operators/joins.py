"""Joins between the large tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.operators.aggregates import concat_by_range
from muster.operators.filters import after
from muster.operators.lookups import Tables, has_option, join_dim, option_label
from muster.operators.updates import unique_or_fail


def join_primary(df: DataFrame, detail: DataFrame, cols: Sequence[str], key: str = "contact_id") -> DataFrame:
    """Left join on a contact's primary address, e-mail or phone; ``cols`` may rename with 'a AS b'."""
    primary = detail.filter(F.col("is_primary") == 1).selectExpr("contact_id AS _owner", *cols)
    return df.join(primary, F.col(key) == F.col("_owner"), "left").drop("_owner")


def attach(df: DataFrame, agg: DataFrame, key: str) -> DataFrame:
    """Left join of one row per key; keys without one keep NULL."""
    return df.join(agg, key, "left")


def with_phone(df: DataFrame, phone: DataFrame, key: str = "contact_id") -> DataFrame:
    """Rows whose contact has any phone number, primary or not."""
    owners = phone.filter(F.col("phone").isNotNull()).select(F.col("contact_id").alias(key))
    return df.join(owners, key, "left_semi")


def petition_activities(t: Tables) -> DataFrame:
    """(activity_id, survey_id) of every petition activity whose survey has a campaign.

    The rows carry numbers only; titles are looked up at the end.
    """
    topics = t["campaign"].select(F.col("id").alias("campaign_id"))
    return survey_activities(t, t["survey"].join(topics, "campaign_id", "left_semi"))


def survey_activities(t: Tables, surveys: DataFrame) -> DataFrame:
    """(activity_id, survey_id) of every petition activity of one of the surveys, which must agree on the type."""
    surveys = surveys.select(F.col("id").alias("survey_id"), F.col("activity_type_id"))
    signed = has_option(t["activity"], t, "activity_type_id", "activity_type", ["Petition"], by="name").select(
        F.col("id").alias("activity_id"), "activity_type_id", F.col("source_record_id").alias("survey_id")
    )
    return signed.join(surveys, ["survey_id", "activity_type_id"], "left_semi").select("activity_id", "survey_id")


def petitions(t: Tables, ids: DataFrame | None = None) -> DataFrame:
    """(contact_id, activity_id, survey_id) for every role a contact has in a petition."""
    links = t["activity_contact"].select("activity_id", "contact_id")
    if ids is not None:
        links = links.join(ids, "contact_id", "left_semi")
    return links.join(petition_activities(t), "activity_id")


def with_titles(df: DataFrame, t: Tables) -> DataFrame:
    """Replace survey_id by the survey's title (petition) and its campaign's title (campaign_topic)."""
    surveys = t["survey"].select(F.col("id").alias("survey_id"), F.col("title").alias("petition"), "campaign_id")
    topics = t["campaign"].select(F.col("id").alias("campaign_id"), F.col("title").alias("campaign_topic"))
    return df.join(surveys, "survey_id").join(topics, "campaign_id").drop("survey_id", "campaign_id")


#: Activities, by number, whose texts a contact's first list holds.
TEXT_RANGE = 1 << 20


def _numbered_titles(t: Tables) -> DataFrame:
    """(survey_id, numbers, petition, campaign_topic): the titles of a survey, each with the number that all equal titles share."""

    def first(title: str, number: str) -> Column:
        return F.min(number).over(Window.partitionBy(title))

    surveys = t["survey"].select(F.col("id").alias("survey_id"), F.col("title").alias("petition"), "campaign_id")
    topics = t["campaign"].select(F.col("id").alias("campaign_id"), F.col("title").alias("campaign_topic"))
    topics = topics.withColumn("topic_number", first("campaign_topic", "campaign_id"))
    named = surveys.join(topics, "campaign_id").withColumn("petition_number", first("petition", "survey_id"))
    return named.withColumn("numbers", F.array("petition_number", "topic_number"))


def petition_texts(t: Tables, ids: DataFrame | None = None) -> DataFrame:
    """Per contact (of ``ids``) its petitions and their campaigns as texts, each in the order of the first activity.

    Links are first grouped by contact and number of the title, on the map side first: what is shuffled are numbers, and a contact
    with very many links shrinks to its different titles. Titles replace their numbers after that, in the text that
    ``concat_by_range`` puts together in two steps.
    """
    titles = _numbered_titles(t)
    numbers = petitions(t, ids).join(titles.select("survey_id", "numbers"), "survey_id")
    numbers = numbers.select("contact_id", "activity_id", F.posexplode("numbers").alias("kind", "number"))
    first = numbers.groupBy("contact_id", "kind", "number").agg(F.min("activity_id").alias("activity_id"))
    named = [
        F.struct(F.lit(kind).alias("kind"), F.col(number).alias("number"), F.col(title).alias("text"))
        for kind, (number, title) in enumerate([("petition_number", "petition"), ("topic_number", "campaign_topic")])
    ]
    titled = first.join(titles.select(F.inline(F.array(*named))).distinct(), ["kind", "number"])
    return concat_by_range(titled, "contact_id", ["petition", "campaign_topic"], "activity_id", TEXT_RANGE)


def with_recurring(df: DataFrame, t: Tables, as_of: datetime | None = None) -> DataFrame:
    """Memberships with their payment instrument and a recurring contribution (due after ``as_of``)."""
    recurring = t["contribution_recur"]
    if as_of is not None:
        recurring = after(recurring, "next_sched_contribution_date", as_of)
    payment = t["value_membership_payment"].select(
        F.col("entity_id").alias("id"), "payment_instrument", "membership_recurring_contribution"
    )
    due = recurring.select(F.col("id").alias("membership_recurring_contribution"), "next_sched_contribution_date")
    return df.join(payment, "id").join(due, "membership_recurring_contribution")


def membership_contributions(t: Tables, statuses: Sequence[str], links: DataFrame | None = None) -> DataFrame:
    """Links (membership_id, contribution_id), all or the given ones, whose contribution has one of the statuses.

    Given links first cut the contributions, so that few links let few of them through.
    """
    wanted = has_option(t["contribution"], t, "contribution_status_id", "contribution_status", statuses)
    wanted = wanted.select(F.col("id").alias("contribution_id"))
    if links is None:
        links = t["membership_payment"]
    else:
        wanted = wanted.join(links.select("contribution_id"), "contribution_id", "left_semi")
    return links.join(wanted, "contribution_id", "left_semi")


def order_contacts(t: Tables, orders: DataFrame) -> DataFrame:
    """The contacts of the orders with prefix, primary address, country and e-mail, as order lines show them.

    For a person the organisation name is the employer's; other contacts have no employer. Contacts, addresses and
    e-mails are cut down to those with an order before anything is joined to them. There must be one row per
    contact: a second one would double its orders and fails.
    """
    buyers = orders.select(F.col("source_contact_id").alias("id")).distinct()
    owners = buyers.withColumnRenamed("id", "contact_id")
    employer = F.when(F.col("contact_type") == "Individual", F.col("organization_name")).alias("current_employer")
    contact = t["contact"].join(buyers, "id", "left_semi").select(
        "id", "formal_title", "prefix_id", "first_name", "last_name", employer
    )
    address = join_dim(
        t["address"].join(owners, "contact_id", "left_semi"),
        t["country"].select("id", F.col("name").alias("country")),
        "country_id",
        ["country"],
    )
    email = t["email"].join(owners, "contact_id", "left_semi")
    place = ["street_address", "state_province", "city", "postal_code", "country"]
    named = join_primary(join_primary(contact, address, place, key="id"), email, ["email"], key="id")
    named = option_label(named, t, "prefix_id", "individual_prefix", out="individual_prefix").drop("prefix_id")
    return unique_or_fail(named, "id", apart=True)


def with_contact(orders: DataFrame, contact: DataFrame) -> DataFrame:
    """Each order with its source contact; an order without a contact stops the job.

    One contact may have placed a large part of all orders: both inputs come straight from their shuffle, so
    adaptive execution can split that contact's orders.
    """
    people = contact.withColumnRenamed("id", "source_contact_id").withColumn("_found", F.lit(True))
    joined = orders.join(people, "source_contact_id", "left")
    message = F.concat(F.lit("order without contact: "), F.col("id").cast("string"))
    complete = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return joined.filter(complete).drop("_found")
