"""Row filters. A NULL operand never passes, unless a docstring says otherwise."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions.dates import ago, first_day_from, moment

# Fixed value: days of the month on which no calls are planned.
QUIET_DAYS = (2, 9, 16, 24)
# Fixed value: the name a contact carries in polymorphic links.
CONTACT_ENTITY = "civicrm_contact"
# Roles of a contact in an activity.
ROLE_ASSIGNEE, ROLE_SOURCE, ROLE_TARGET = 1, 2, 3


def keep_unflagged(df: DataFrame, flags: Iterable[str]) -> DataFrame:
    """Rows whose 0/1 flags are all 0."""
    return df.filter(reduce(Column.__and__, [F.col(flag) == 0 for flag in flags]))


def filter_type(df: DataFrame, kind: str) -> DataFrame:
    return df.filter(F.col("contact_type") == kind)


def require(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def not_prefixed(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose text does not start with ``prefix``; rows without text go as well."""
    return df.filter(~F.startswith(F.col(column), F.lit(prefix)))


def _comparable(df: DataFrame, column: str, bound: Column) -> Column:
    return first_day_from(bound) if isinstance(df.schema[column].dataType, T.DateType) else bound


def since_condition(df: DataFrame, column: str, as_of: datetime, back: tuple[int, str]) -> Column:
    """Whether the row is from ``as_of - back`` on."""
    return F.col(column) >= _comparable(df, column, ago(as_of, *back))


def since(
    df: DataFrame,
    column: str,
    as_of: datetime,
    back: tuple[int, str],
    until: tuple[int, str] | None = None,
) -> DataFrame:
    """Rows from ``as_of - back`` on, and before ``as_of - until`` if given; a date counts as its midnight."""
    kept = df.filter(since_condition(df, column, as_of, back))
    if until is not None:
        kept = kept.filter(F.col(column) < _comparable(df, column, ago(as_of, *until)))
    return kept


def floor_date(df: DataFrame, column: str, day: str) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(day).cast("date"))


def after(df: DataFrame, column: str, as_of: datetime) -> DataFrame:
    return df.filter(F.col(column) > moment(as_of))


def run_day_gate(df: DataFrame, as_of: datetime, days: Sequence[int] = QUIET_DAYS) -> DataFrame:
    """Everything, or nothing when ``as_of`` falls on one of the days of the month."""
    return df.filter(~F.dayofmonth(moment(as_of)).isin(list(days)))


def postal_reasons(country: str = "AT", max_returns: int = 2) -> Column:
    """Whether a contact joined with address, statistics and country must not get post.

    Plain three-valued logic: an unknown country or an unknown count of returned letters does not disqualify,
    a missing street, code, town or name does, an empty text does not.
    """
    kind = F.col("contact_type")
    person, household = kind == "Individual", kind == "Household"
    reasons = [
        F.col("is_deleted") == 1,
        F.col("is_deceased") == 1,
        F.col("do_not_mail") == 1,
        F.col("iso_code") != country,
        *[F.col(part).isNull() for part in ("street_address", "postal_code", "city")],
        F.col("rts_counter") >= max_returns,
        kind == "Organization",
        person & F.col("first_name").isNull(),
        person & F.col("last_name").isNull(),
        household & F.col("household_name").isNull(),
    ]
    return reduce(Column.__or__, reasons)


def postal_disqualified(df: DataFrame, country: str = "AT", max_returns: int = 2) -> DataFrame:
    return df.filter(postal_reasons(country, max_returns))


def link_scope(df: DataFrame, entity: str = CONTACT_ENTITY) -> DataFrame:
    return df.filter(F.col("entity_table") == entity)


def with_role(df: DataFrame, role: int = ROLE_TARGET) -> DataFrame:
    return df.filter(F.col("record_type_id") == role)
