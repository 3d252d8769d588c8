"""Sets of ids: suppress (anti joins), keep (semi joins), union.

A set is a DataFrame with one key column. Rules return it distinct, so a key that occurs very often in a
fact table has already shrunk to one row (on the map side first) before it meets the audience.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_ids(*ids: DataFrame, distinct: bool = False) -> DataFrame:
    """All ids of several sets. Semi and anti joins do not need them distinct."""
    together = reduce(DataFrame.unionByName, ids)
    return together.distinct() if distinct else together


def suppress(df: DataFrame, rules: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in none of the sets.

    One anti join against all sets at once: the order of suppressions cannot matter, as none of them reads
    what another one leaves.
    """
    return df.join(union_ids(*rules), key, "left_anti")


def suppress_where(df: DataFrame, reason: Column, key: str) -> DataFrame:
    """Rows whose key has no row with ``reason``, for reasons that the rows themselves hold.

    The same as suppressing the set of these keys, without computing the rows a second time: behind a join on
    ``key`` the window needs no shuffle of its own.
    """
    hit = F.max(F.coalesce(reason, F.lit(False))).over(Window.partitionBy(key))
    return df.withColumn("_hit", hit).filter(~F.col("_hit")).drop("_hit")


def keep(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def within(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is in ``ids`` (key); without ids all rows.

    No hint and no count: Spark broadcasts a small set by its own statistics, and for a larger one the shuffle is that
    which the rows need next anyway.
    """
    return df if ids is None else df.join(ids, key, "left_semi")


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """SQL's NOT IN for a key that is never NULL: a single NULL in ``other`` leaves no row at all.

    The literal NOT IN makes Spark broadcast ``other`` whatever its size. Here the NULL test is one scalar
    and the rest an ordinary anti join.
    """
    absent = df.join(other.select(key).distinct(), key, "left_anti")
    return absent.filter(~other.filter(F.col(key).isNull()).exists())


def existing(ids: DataFrame, contact: DataFrame, key: str = "contact_id") -> DataFrame:
    """Ids that have a row in the contact table."""
    return ids.join(contact.select(F.col("id").alias(key)), key, "left_semi")
