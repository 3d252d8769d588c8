"""Connected components of links by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import Stage

#: Edges that a task reads, about, and ids that it holds at most while it contracts them.
_PORTION, _HELD = 200_000, 500_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as one star for each of its connected parts: every id with the smallest one that it reaches."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            while (up := parent.setdefault(a, a)) != a:
                parent[a] = a = parent[up]
            while (up := parent.setdefault(b, b)) != b:
                parent[b] = b = parent[up]
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= _HELD:
            yield _stars(parent)
            parent = {}
    yield _stars(parent)


def _stars(parent: dict[int, int]) -> pa.RecordBatch:
    pairs = []
    # Parents are smaller, so in ascending order each one's own is known.
    for a in sorted(parent):
        top = parent[a] = parent[parent[a]]
        if top != a:
            pairs.append((a, top))
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _portions(edges: DataFrame, stage: Stage) -> DataFrame:
    """The staged edges contracted by tasks that each read a portion of them."""
    tasks = -(-edges.count() // _PORTION)
    return stage(edges.coalesce(max(tasks, 1)).mapInArrow(_contracted, "a long, b long").distinct())


def _is_forest(star: DataFrame) -> bool:
    """Every id has one parent at most, and no parent has one."""
    up = star.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = star.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = up.unionByName(down).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame, stage: Stage, max_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (a, b); the component is named by its smallest id.

    Each round links all larger neighbours of an id, then all smaller ones, to its smallest neighbour, so the number of
    rounds grows with the logarithm of the links and no id's neighbours are ever gathered. Before each round tasks contract
    the edges, each a portion of bounded size, whatever ids it holds. Minima are written before they are joined: both
    inputs of each join come straight from their shuffle, where adaptive execution splits a frequent id.
    """
    star = _portions(stage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), stage)
    for _ in range(max_rounds):
        if _is_forest(star):
            break
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")))
        wide = stage(
            both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        lowest = stage(wide.groupBy("a").agg(F.min("b").alias("low")))
        near = wide.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        star = _portions(stage(near.unionByName(lowest.withColumnRenamed("low", "b"))), stage)
    else:
        raise RuntimeError(f"no stable components after {max_rounds} rounds")
    members = star.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    roots = star.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    return members.unionByName(roots)
