"""Grouping: sums with a threshold, concatenated texts, distinct rows, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def sum_by(df: DataFrame, key: str, column: str, out: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(column).alias(out))


def sum_at_least(df: DataFrame, key: str, column: str, threshold: float) -> DataFrame:
    """Keys whose sum reaches the threshold, with the sum as ``total``."""
    return sum_by(df, key, column).filter(F.col("total") >= threshold)


def concat_distinct(df: DataFrame, key: str, column: str, sep: str = ", ", out: str | None = None) -> DataFrame:
    """Per key the distinct texts in their own order; NULLs are left out, a key with nothing else gets NULL.

    Repeats are removed before the shuffle, so a key's list is as long as its number of different texts. Texts
    differ here when their bytes do, whatever their collation.
    """
    texts = F.array_join(F.sort_array(F.collect_set(F.col(column).cast("string"))), sep)
    return df.groupBy(key).agg(F.when(F.count(column) > 0, texts).alias(out or column))


def concat_by_range(
    df: DataFrame, key: str, texts: Sequence[str], order: str, width: int, sep: str = ", "
) -> DataFrame:
    """Per key and kind of text the texts in the order of ``order``, put together in two steps.

    ``df`` has one row (key, kind, order, text) per key and different text; ``kind`` is the place of the text's column in
    ``texts``. A first grouping puts together what lies in one range of ``width`` order values, a second one the ranges: a key with
    very many texts is many lists in many tasks, and the last task sees one finished text a range. Texts with the same order
    value are ordered by themselves, which makes the result repeatable. NULLs are left out; a key with nothing else gets NULL.
    """
    entry = F.struct(F.col(order).alias("at"), F.col("text").alias("text"))
    listed = F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), entry))).getField("text")
    ranged = df.withColumn("_range", F.floor(F.col(order) / width))
    parts = ranged.groupBy(key, "kind", "_range").agg(F.when(F.count("text") > 0, F.array_join(listed, sep)).alias("part"))

    def whole(kind: int, column: str) -> Column:
        mine = F.when((F.col("kind") == kind) & F.col("part").isNotNull(), F.struct("_range", "part"))
        ordered = F.sort_array(F.collect_list(mine)).getField("part")
        return F.when(F.count(mine) > 0, F.array_join(ordered, sep)).alias(column)

    return parts.groupBy(key).agg(*[whole(kind, column) for kind, column in enumerate(texts)])


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
