"""Follow-up records for exported contacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.dates import moment
from muster.operators.filters import ROLE_ASSIGNEE, ROLE_SOURCE, ROLE_TARGET
from muster.operators.lookups import Tables, lookup_id, option_code
from muster.operators.sets import existing
from muster.sinks import ids


def _record(
    t: Tables, number: Column, subject: str | Column, kind: str, status: str, campaign: Column, as_of: datetime
) -> list[Column]:
    """The columns of an activity as the tables hold them, and its subject."""
    return [
        number.cast("bigint").alias("id"),
        option_code(t, "activity_type", kind).alias("activity_type_id"),
        campaign.cast("bigint").alias("campaign_id"),
        option_code(t, "activity_status", status).alias("status_id"),
        moment(as_of).alias("activity_date_time"),
        F.lit(None).cast("bigint").alias("source_record_id"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
    ]


def mass_activity(
    exported: DataFrame, t: Tables, as_of: datetime, number: int, subject: str = "", campaign: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """One completed action, and one target link per exported contact that exists in the contact table.

    Both fit the tables ``activity`` and ``activity_contact``, so that the next run's rules see them once they are
    appended. ``campaign`` is an external identifier. ``number`` is the activity's id, which the run has reserved. Without an
    exported contact there is no activity either.
    """
    people = exported.select("contact_id").distinct()
    of = F.lit(None) if campaign is None else lookup_id(t["campaign"], F.col("external_identifier") == campaign)
    columns = _record(t, F.lit(number), subject, "Action", "Completed", of, as_of)
    some = people.groupBy().agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0)
    links = existing(people, t["contact"]).select(
        F.lit(number).cast("bigint").alias("activity_id"), "contact_id", F.lit(ROLE_TARGET).alias("record_type_id")
    )
    return some.select(*columns), links


@dataclass(frozen=True)
class CallPlan:
    """What a planned call says and who is involved. The numbers are fixed values of the installation."""

    subject: str = "Service Call"
    activity_type: str = "Outgoing Call"
    status: str = "Scheduled"
    campaign_id: int = 43
    assignees: Sequence[int] = (94, 77, 105)
    source: int = 16


def number_calls(exported: DataFrame, t: Tables, book: str, run_id: str, path: str, *earlier: DataFrame) -> DataFrame:
    """(contact_id, activity_id) of every exported contact, with ids that this run has reserved; staged below ``path``.

    The ids lie above those of the activity table and of ``earlier`` records.
    """
    people = ids.numbered(exported.select("contact_id").distinct(), path)
    spark, count = exported.sparkSession, people.count()
    firsts = ids.reserve(spark, book, run_id, count, ids.highest_id(t["activity"], *earlier)) if count else [0]
    return people.select("contact_id", ids.id_of(F.col("number"), firsts).alias("activity_id"))


def call_tasks(numbered: DataFrame, t: Tables, as_of: datetime, plan: CallPlan = CallPlan()) -> tuple[DataFrame, DataFrame]:
    """Per numbered contact one planned call, and its links: the contact, the assignees, the source."""
    calls = numbered.select(
        *_record(t, F.col("activity_id"), plan.subject, plan.activity_type, plan.status, F.lit(plan.campaign_id), as_of)
    )

    def link(contact: Column, role: int) -> Column:
        return F.struct(contact.cast("bigint").alias("contact_id"), F.lit(role).alias("record_type_id"))

    people = [
        link(F.col("contact_id"), ROLE_TARGET),
        *[link(F.lit(assignee), ROLE_ASSIGNEE) for assignee in plan.assignees],
        link(F.lit(plan.source), ROLE_SOURCE),
    ]
    return calls, numbered.select("activity_id", F.inline(F.array(*people)))
