"""Scalar expressions on customer numbers, names and delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widths of the two customer number formats (campaign, contact).
CUT_WIDTHS = (5, 9)
FULL_WIDTHS = (4, 9)

# Characters that make a field quoted in the byte-exact line form, besides the separator.
_QUOTED_WHEN = "[\"\\\\\\n\\r\\t ]"


def customer_no_cut(campaign: Column, contact: Column) -> Column:
    """``00007C000000042``; a number longer than its width is cut, a NULL part makes the whole NULL."""
    left, right = CUT_WIDTHS
    return F.concat(
        F.lpad(campaign.cast("string"), left, "0"), F.lit("C"), F.lpad(contact.cast("string"), right, "0")
    )


def _pad_full(value: Column, width: int) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def customer_no_full(campaign: Column, contact: Column) -> Column:
    """``0007C000000042``; longer numbers stay whole, a missing campaign counts as 0."""
    left, right = FULL_WIDTHS
    return F.concat(_pad_full(F.coalesce(campaign, F.lit(0)), left), F.lit("C"), _pad_full(contact, right))


def name_by_type() -> Column:
    """The surname or the organisation's or household's name, by contact type."""
    kind = F.col("contact_type")
    return (
        F.when(kind == "Individual", F.col("last_name"))
        .when(kind == "Organization", F.col("organization_name"))
        .when(kind == "Household", F.col("household_name"))
    )


def typed_null(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def csv_field(column: Column, sep: str = ";") -> Column:
    """One field of a delimited line.

    Quoted when it holds the separator, a quote, a backslash, a line break, a tab or a blank. Quotes are
    doubled, except right behind a backslash. NULL and '' are both an empty field.
    """
    text = F.coalesce(column.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.regexp_replace(text, r'(?<!\\)"', '""'), F.lit('"'))
    return F.when(F.contains(text, F.lit(sep)) | text.rlike(_QUOTED_WHEN), quoted).otherwise(text)


def csv_line(columns: Sequence[Column], sep: str = ";") -> Column:
    return F.concat_ws(sep, *[csv_field(column, sep) for column in columns])
