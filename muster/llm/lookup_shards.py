"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import Stage

#: Slots of the table, a prime: far more than shards, so that shares are even to a few tenths of a percent.
SLOTS = 65_537
#: The table is broadcast; no table may be larger.
MOST_SLOTS = 1 << 20


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot.

    Each shard has its own order of preference over all slots: start and step come from its name, and as ``slots`` is prime
    every step visits all of them. Shards take turns, each claiming its next free slot, until none is free. So
    shares differ by one slot at most, and a shard that leaves or joins changes few slots of the others.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names")
    if len(shards) > slots or slots > MOST_SLOTS or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime between the number of shards and {MOST_SLOTS}")
    at = [xxhash.xxh3_64_intdigest(name, seed=1) % slots for name in shards]
    step = [xxhash.xxh3_64_intdigest(name, seed=2) % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    left = slots
    while True:
        for shard in range(len(shards)):
            slot = at[shard]
            while owner[slot] >= 0:
                slot = (slot + step[shard]) % slots
            owner[slot] = shard
            at[shard] = (slot + step[shard]) % slots
            left -= 1
            if not left:
                return owner


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) of every slot."""
    rows = [(slot, shards[shard]) for slot, shard in enumerate(fill(shards, slots))]
    return spark.createDataFrame(rows, "slot int, shard string")


def _text_of(*key: Column) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(part.cast("string"), F.lit("\x00")) for part in key])


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; null parts of a key are a value like any other."""
    return F.pmod(F.xxhash64(_text_of(*key)), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: list[str], key: list[str], slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``: rows of equal keys share a shard.

    The table has a fixed number of slots and is broadcast, so rows are placed where they are read. Columns of ``docs`` that
    are named as the two new ones are replaced. Null keys share one slot. No rows give no rows.
    """
    table = lookup(docs.sparkSession, shards, slots)
    rows = docs.withColumn("slot", slot_of(*[docs[f"`{c}`"] for c in key], slots=slots)).drop("shard")
    return rows.join(F.broadcast(table), "slot").select(*rows.columns, "shard")


def place_evenly(
    docs: DataFrame, shards: list[str], key: list[str], within: list[str], slots: int = SLOTS, stage: Stage | None = None
) -> DataFrame:
    """As ``place``, with frequent keys split: a key with more rows than an even shard has is dealt out in parts of
    an eighth of a shard, by a hash of ``within``. ``parts`` tells into how many.

    Rows with equal ``key`` and ``within`` stay together, so repeated rows do. Null keys are one key and are split like any other.
    An empty table gives no row. ``docs`` may have any columns; those named as the three new ones are replaced.
    """
    stage = stage or Stage(docs.sparkSession)
    names = [f"`{c}`" for c in docs.columns if c not in ("slot", "shard", "parts")]
    text = _text_of(*[docs[f"`{c}`"] for c in key])
    salt = F.xxhash64(F.struct(*[docs[f"`{c}`"] for c in within]))
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), text.alias("key_text"), salt.alias("salt"))
    rows = rows.withColumn("key_hash", F.xxhash64("key_text"))
    total = stage(rows.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")))
    share = total.agg(F.greatest(F.lit(1.0), F.sum("n") / len(shards)).alias("share")).first()[0]
    # A key that fills a shard is one of at most as many keys as there are shards.
    heavy = stage(total.filter(F.col("n") > share).select("key_hash", F.ceil(8 * F.col("n") / share).cast("int").alias("parts")))
    rows = rows.join(F.broadcast(heavy), "key_hash", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(F.col("parts") > 1, F.pmod("salt", F.col("parts"))).otherwise(0)
    rows = rows.withColumn("slot", slot_of(F.col("key_text"), part, slots=slots))
    table = lookup(docs.sparkSession, shards, slots)
    return rows.join(F.broadcast(table), "slot").select("row.*", "slot", "shard", "parts")
