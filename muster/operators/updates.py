"""Steps that fill columns of an audience, check its key or add new rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.operators.lookups import Tables, lookup_id


def add_group_status(df: DataFrame, t: Tables, titles: Mapping[str, str], key: str = "contact_id") -> DataFrame:
    """For each ``column: group title`` the contact's status in that group, also 'Removed'; else NULL.

    All groups are read in one pass; one row per contact comes back.
    """
    group_ids = {column: lookup_id(t["group"], F.col("title") == title) for column, title in titles.items()}
    members = t["group_contact"]
    wanted = None
    for group_id in group_ids.values():
        here = F.col("group_id") == group_id
        wanted = here if wanted is None else wanted | here
    statuses = (
        members.filter(wanted)
        .groupBy(F.col("contact_id").alias(key))
        .agg(*[F.max(F.when(F.col("group_id") == gid, F.col("status"))).alias(column) for column, gid in group_ids.items()])
    )
    return df.join(statuses, key, "left")


def unique_or_fail(df: DataFrame, key: str, apart: bool = False) -> DataFrame:
    """The same rows; the job fails on a key that occurs twice.

    Part of the query itself: behind joins on ``key`` the window reuses their partitioning and order. With ``apart``
    the rows are not left partitioned by ``key``, so the next join on it gets them straight from a shuffle,
    where adaptive execution can split the other side's frequent keys.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(F.struct(key) if apart else F.col(key)))
    message = F.concat(F.lit(f"duplicate key {key}="), F.col(key).cast("string"))
    checked = F.when(F.col("_copies") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.withColumn("_copies", copies).filter(checked).drop("_copies")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def insert_new(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that are to be added: first of each key, and only keys the target does not hold."""
    return rows.dropDuplicates(list(key)).join(target.select(*key), list(key), "left_anti")
