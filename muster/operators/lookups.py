"""Lookups in code tables.

Entries asked for by name (a status, a tag, a group) become a scalar: a handful of codes is compared in place, so
rows that share one code never have to meet in one task. Whole dimensions are joined, without a broadcast hint:
these joins are built from filters and semi joins, whose estimated size never exceeds the table's own, so
Spark broadcasts a table under its threshold and shuffles a larger one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def lookup_id(table: DataFrame, where: Column, take: str = "id") -> Column:
    """The one value of ``take`` under a condition: NULL when there is none, an error when there are several."""
    return table.filter(where).select(take).scalar()


def named_keys(table: DataFrame, column: str, values: Sequence[str], take: str = "id") -> Column:
    """The keys of the entries with one of these names, as an array scalar."""
    return _keys(table.filter(F.col(column).isin(list(values))), take)


def _keys(entries: DataFrame, take: str) -> Column:
    return entries.agg(F.collect_set(F.col(take).cast("bigint"))).scalar()


def one_of(column: str, keys: Column) -> Column:
    """Whether the column holds one of the keys; NULL for NULL."""
    return F.array_contains(keys, F.col(column).cast("bigint"))


def option_group_id(t: Tables, group: str) -> Column:
    return lookup_id(t["option_group"], F.col("name") == group)


def option_codes(
    t: Tables, group: str, values: Sequence[str] | None = None, by: str = "label"
) -> DataFrame:
    """One option group as (code, name, label), limited to some names or labels.

    Codes are stored as text; a text that is no number matches no code.
    """
    options = t["option_value"].filter(F.col("option_group_id") == option_group_id(t, group))
    if values is not None:
        options = options.filter(F.col(by).isin(list(values)))
    code = F.col("value").try_cast("bigint")
    return options.filter(code.isNotNull()).select(code.alias("code"), "name", "label")


def option_code(t: Tables, group: str, name: str) -> Column:
    """The code of one option as an int scalar, the type of the columns that hold codes."""
    return option_codes(t, group, [name], by="name").select(F.col("code").try_cast("int")).scalar()


def option_label(
    df: DataFrame, t: Tables, code_column: str, group: str, take: str = "label", out: str = "label"
) -> DataFrame:
    """Add the option's label (or name); rows without a matching option keep NULL."""
    options = option_codes(t, group).select(F.col("code").alias("_code"), F.col(take).alias(out))
    code = F.col(code_column).try_cast("bigint")
    return df.join(options, code == F.col("_code"), "left").drop("_code")


def has_option(
    df: DataFrame, t: Tables, code_column: str, group: str, values: Sequence[str], by: str = "label"
) -> DataFrame:
    """Rows whose code belongs to one of the named options."""
    return df.filter(option_in(t, code_column, group, values, by))


def option_in(t: Tables, code_column: str, group: str, values: Sequence[str], by: str = "label") -> Column:
    """Whether the code belongs to one of the named options."""
    return one_of(code_column, _keys(option_codes(t, group, values, by), "code"))


def has_value(df: DataFrame, table: DataFrame, code_column: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose code is the id of a row of ``table`` with one of the values."""
    return df.filter(one_of(code_column, named_keys(table, column, values)))


def join_dim(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str], key: str = "id") -> DataFrame:
    """Left join on a dimension; several dimension rows for one key multiply the row."""
    side = dim.select(F.col(key).alias("_key"), *cols)
    return df.join(side, F.col(on) == F.col("_key"), "left").drop("_key")


def mark_campaigns(campaign: DataFrame, root: str, max_depth: int = 3) -> DataFrame:
    """All campaigns with ``under_root``: whether one or one of its nearest ``max_depth`` ancestors is named ``root``.

    One self join per generation, each on what the one before found.
    """
    called = F.coalesce(F.col("name") == root, F.lit(False))
    marked = campaign.withColumns({"under_root": called, "_above": F.col("parent_id")})
    parents = campaign.select(F.col("id").alias("_id"), called.alias("_hit"), F.col("parent_id").alias("_next"))
    for _ in range(max_depth):
        joined = marked.join(parents, F.col("_above") == F.col("_id"), "left")
        reached = F.col("under_root") | F.coalesce("_hit", F.lit(False))
        marked = joined.withColumns({"under_root": reached, "_above": F.col("_next")}).drop("_id", "_hit", "_next")
    return marked.drop("_above")


def root_ids(campaign: DataFrame, root: str, max_depth: int = 3) -> DataFrame:
    """Campaigns named ``root`` and their descendants down to ``max_depth`` generations."""
    return mark_campaigns(campaign, root, max_depth).filter("under_root").select("id")


def under_root(df: DataFrame, campaign: DataFrame, root: str, max_depth: int = 3) -> DataFrame:
    """Rows whose campaign, or one of its nearest ``max_depth`` ancestors, is named ``root``."""
    ids = root_ids(campaign, root, max_depth).select(F.col("id").alias("campaign_id"))
    return df.join(ids, "campaign_id", "left_semi")


def in_campaigns(df: DataFrame, campaign: DataFrame, ext_id: str, title: str | None = None) -> DataFrame:
    """Rows of a campaign with this external identifier (or this title)."""
    wanted = campaign.filter(in_title_or_id(ext_id, title)).select(F.col("id").alias("campaign_id"))
    return df.join(wanted, "campaign_id", "left_semi")


def in_title_or_id(ext_id: str, title: str | None = None) -> Column:
    wanted = F.col("external_identifier") == ext_id
    return wanted if title is None else wanted | (F.col("title") == title)
