"""Ids for new rows: ranges that one run holds alone, and dense numbers for rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.sinks import storage
from muster.sinks.place import stage

#: Ids in a block. A run holds whole blocks.
BLOCK = 1024


def reserve(spark: SparkSession, book: str, run_id: str, count: int, highest: int, block: int = BLOCK) -> list[int]:
    """The first ids of as many blocks as ``count`` ids need, all above ``highest`` and held by this run alone.

    ``book`` is a folder for all runs that number rows of one table. A block is held by creating the file of its number,
    which must not exist: of two runs at once each gets other blocks, and a run that dies leaves a gap. A run that asks again gets
    the blocks that it already holds.
    """
    held = f"{book}/runs/{run_id}"
    blocks = [int(number) for number in storage.note(spark, held).split()] if storage.exists(spark, held) else []
    needed = -(-count // block)
    if len(blocks) >= needed:
        return [number * block for number in blocks[:needed]]
    taken = [int(path.rsplit("/", 1)[1]) for path in storage.find(spark, f"{book}/blocks/*")]
    number = max([highest // block, *taken]) + 1
    while len(blocks) < needed:
        if storage.claim(spark, f"{book}/blocks/{number}", run_id):
            blocks.append(number)
        number += 1
    storage.delete(spark, held)
    storage.claim(spark, held, " ".join(map(str, blocks)))
    return [number * block for number in blocks]


def highest_id(*tables: DataFrame, column: str = "id") -> int:
    """The highest id that any of the tables holds; 0 without any."""
    return max((table.agg(F.max(column)).first()[0] or 0) for table in tables)


def numbered(rows: DataFrame, path: str, out: str = "number") -> DataFrame:
    """``rows`` with the numbers 0, 1, 2, ... in no particular order, staged below ``path``.

    Each task counts its own rows; a task's first number is the sum of the counts before it, of which there is one a task.
    """
    placed = stage(rows.withColumn("_place", F.monotonically_increasing_id()), f"{path}/placed")
    part = F.shiftright("_place", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_count"))
    firsts = counts.select("_part", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_first"))
    whole = placed.withColumn("_part", F.shiftright("_place", 33)).join(firsts, "_part")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return stage(whole.withColumn(out, F.col("_first") + within).drop("_part", "_place", "_first"), f"{path}/numbered")


def id_of(number: Column, firsts: Sequence[int], block: int = BLOCK) -> Column:
    """The id of a row by its number: the blocks are filled one after the other."""
    starts = F.array(*[F.lit(first).cast("bigint") for first in firsts])
    return F.element_at(starts, (F.floor(number / block) + 1).cast("int")) + number % block
