"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muster.llm.common import WORD, Stage

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (5, 2, 1)
#: No source is read more often than this.
MOST_EPOCHS = 3
#: Ranges of keys that a source's running sum is cut into; each is summed apart.
RANGES = 4096
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source: (source, source_size).

    The sources share the sum of all sizes by weight; a target stops at ``most`` times its source's size and the excess goes
    to the others by weight until none is above. That is one level for all: a source gets min(most * size, weight *
    level). Sources reach their cap in the order of cap by weight, so the level follows from running sums.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    kinds = F.array(*map(F.lit, weights))
    cap = most * F.col("source_size")
    ranked = sizes.withColumn("weight", F.element_at(kinds, ((number - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", cap)
    order = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # The level if all sources before this one are at their cap and none from here on.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("level", level)
    # The first that does not reach its cap under its level sets the level of all that follow.
    free = F.col("weight") * F.col("level") < F.col("cap")
    final = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    reached = F.coalesce(F.col("weight") * final, F.col("cap").cast("double"))
    return levels.select("source", "source_size", F.least(reached, F.col("cap").cast("double")).alias("target"))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """An exponential variate by document weight: -ln(u) / weight, u in (0, 1) from the id's digest. Small keys come first."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"))), 1, 13)
    uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(uniform) / weight


def mix(docs: DataFrame, quality: DataFrame | None = None, stage: Stage | None = None, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, weight, taken) of every row of ``docs`` (doc_id, text, source).

    A source with a target of e.g. 2.4 times its size gives two complete epochs of all its documents, then documents in
    the order of their exponential keys until the rest of the target is filled; the last of them gives only the words that
    are left. ``quality`` (doc_id, quality 0 or 1) weighs documents 2 and 0.5, all others 1; an id with several
    labels counts as their mean.

    Null and empty texts have size 0 and give 0 words. Null sources are a source of their own, the last. Documents with one
    key (repeated rows, null ids) follow by size. With no words at all every target is 0.
    """
    stage = stage or Stage(docs.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", size.alias("size"))
    if quality is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        marks = quality.filter("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("mark"))
        mark = F.when(F.col("mark").isNull(), 1.0).otherwise(0.5 + 1.5 * F.col("mark"))
        sized = sized.join(marks, "doc_id", "left").withColumn("weight", mark).drop("mark")
    key = sampling_key(F.col("doc_id"), F.col("weight"), seed)
    # Keys grow without bound; 1 - exp(-key) deals them evenly over the ranges and keeps their order.
    part = F.floor(RANGES * (1 - F.exp(-F.col("key")))).cast("int")
    sized = stage(sized.withColumn("key", key).withColumn("part", part))
    parts = stage(sized.groupBy("source", "part").agg(F.sum("size").alias("part_size")))
    shares = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    offsets = stage(
        offsets.join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("s"), F.col("part").alias("p"), "offset", "source_size", "target")
    )
    running = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
    running = running.rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("within", F.coalesce(F.sum("size").over(running), F.lit(0)))
    joined = placed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    # Whole epochs of the source, then its words from the front of the order.
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    rest = goal - epochs * F.col("source_size") - F.col("offset") - F.col("within")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", "weight", taken.cast("long").alias("taken")
    )


def repeat(docs: DataFrame, quality: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as half or more of it is taken, with its columns.

    A document cut by the budget stays whole or goes; documents without words go. Rows of one doc_id are taken as
    a whole, by the id's share.
    """
    stage = stage or Stage(docs.sparkSession)
    mixed = mix(docs, quality, stage)
    share = F.sum("taken") / F.nullif(F.sum("size"), F.lit(0))
    copies = mixed.groupBy("doc_id").agg(F.coalesce(F.floor(share + 0.5), F.lit(0)).cast("int").alias("copies"))
    taken = stage(copies.filter("copies > 0").withColumnRenamed("doc_id", "mixed_id"))
    whole = docs.join(taken, docs["doc_id"].eqNullSafe(taken["mixed_id"]))
    # The documents travel as one column, so that none of theirs is taken for one of the mix.
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    return whole.select(row, F.explode(F.array_repeat(F.lit(0), taken["copies"]))).select("row.*")
