"""Points in time. Every export takes one ``as_of`` and never reads the clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: datetime | Column) -> Column:
    """``as_of`` as a literal without time zone, so that the session's zone has no say in the result."""
    if isinstance(as_of, Column):
        return as_of
    return F.expr(f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'")


def ago(as_of: datetime | Column, n: int, unit: str) -> Column:
    """``as_of`` minus ``n`` DAY, MONTH or YEAR; months clamp to the last day of a shorter month."""
    if unit not in ("DAY", "MONTH", "YEAR"):
        raise ValueError(f"unit must be DAY, MONTH or YEAR, not {unit!r}")
    return moment(as_of) - F.expr(f"INTERVAL '{int(n)}' {unit}")


def first_day_from(bound: Column) -> Column:
    """The first day whose midnight is not before ``bound``.

    For a date ``d``: ``d >= bound`` is ``d >= first_day_from(bound)`` and ``d < bound`` is
    ``d < first_day_from(bound)``. Compared like this, the date column stays bare and the filter reaches the scan.
    """
    return (bound + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '0.000001' SECOND")).cast("date")
