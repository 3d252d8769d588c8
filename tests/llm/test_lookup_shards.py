from __future__ import annotations

import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from rows import NASTY, documents

from muster.llm import lookup_shards as ls

SHARDS = [f"s{n}" for n in range(10)]


def _brute_fill(shards, slots):
    """Each shard's whole preference list, then turns."""
    preference = {}
    for name in shards:
        at = xxhash.xxh3_64_intdigest(name, seed=1) % slots
        step = xxhash.xxh3_64_intdigest(name, seed=2) % (slots - 1) + 1
        preference[name] = [(at + i * step) % slots for i in range(slots)]
        assert sorted(preference[name]) == list(range(slots))
    owner = {}
    while len(owner) < slots:
        for n, name in enumerate(shards):
            slot = next((s for s in preference[name] if s not in owner), None)
            if slot is not None:
                owner[slot] = n
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize(("shards", "slots"), [(SHARDS, 101), (["a"], 7), (["a", "b", "c"], 3)])
def test_fill_equals_turn_by_turn(shards, slots):
    assert ls.fill(shards, slots) == _brute_fill(shards, slots)


def test_shares_are_even_and_few_slots_move():
    before, after = ls.fill(SHARDS), ls.fill(SHARDS[:-1])
    sizes = Counter(before).values()
    assert max(sizes) - min(sizes) <= 1
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 9)
    assert moved < 0.1 * ls.SLOTS


@pytest.mark.parametrize(("shards", "slots"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 9, 7), (["a"], 1_048_583)])
def test_refused_tables(shards, slots):
    with pytest.raises(ValueError, match="shards|slots"):
        ls.fill(shards, slots)


def test_place(spark):
    docs = documents(spark, NASTY, clashing=True)
    placed = ls.place(docs, SHARDS, ["doc_id"])
    assert placed.count() == len(NASTY) and set(placed.columns) == {*docs.columns, "slot", "shard"}
    owner = ls.fill(SHARDS)
    by_id = {}
    for r in placed.collect():
        assert r.shard == SHARDS[owner[r.slot]]
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    assert ls.place(documents(spark, []), SHARDS, ["doc_id"]).isEmpty()


def test_frequent_keys_are_split(spark):
    """A key with a third of the rows no longer fills one shard."""
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    plain = ls.place(rows, SHARDS, ["k"]).groupBy("shard").count().agg(F.max("count")).first()[0]
    even = ls.place_evenly(rows, SHARDS, ["k"], ["id"])
    assert even.count() == 6000
    assert plain > 2000 and even.groupBy("shard").count().agg(F.max("count")).first()[0] < 1500
    assert {r.parts for r in even.select("parts").distinct().collect()} == {1, 27}
    assert ls.place_evenly(rows.limit(0), SHARDS, ["k"], ["id"]).isEmpty()


def test_even_places_equal_brute_force(spark):
    """Slots by the same hashes in plain Python, with null keys, null ids, repeated rows and columns of clashing names."""
    rows = [*[(n, "hot") for n in range(300)], *[(n, f"s{n % 40}") for n in range(300, 400)], (None, "hot"), (7, None), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    odd = docs.withColumns({name: F.lit("own") for name in ("key_hash", "key_text", "salt", "row", "split_key", "split_part", "slot", "shard", "parts", "n")})
    found = ls.place_evenly(odd, SHARDS, ["source"], ["doc_id"])
    assert set(found.columns) == set(odd.columns)
    counts, owner = Counter(source for _, source in rows), ls.fill(SHARDS)
    share = len(rows) / len(SHARDS)

    def digest(data: bytes) -> int:
        return xxhash.xxh64_intdigest(data, seed=42)

    got = Counter()
    for r in found.collect():
        parts = -(-8 * counts[r.source] // share) if counts[r.source] > share else 1
        salt = digest(struct.pack("<q", r.doc_id)) if r.doc_id is not None else 42
        signed = salt - (1 << 64) if salt >= 1 << 63 else salt
        part = signed % int(parts) if parts > 1 else 0
        text = f"{chr(0) if r.source is None else r.source}\x1f{part}"
        slot = digest(text.encode())
        slot = (slot - (1 << 64) if slot >= 1 << 63 else slot) % ls.SLOTS
        assert (r.parts, r.slot, r.shard, r.salt) == (parts, slot, SHARDS[owner[slot]], "own")
        got[r.doc_id, r.source] += 1
    assert got == Counter(rows)


def test_the_query_places_every_document(spark):
    from muster.llm.queries import op6_lookup_shards

    found = op6_lookup_shards(spark, "/root/testdata/sf0.01")
    assert found.count() == 1000 and found.filter("shard is null or source_shard is null").isEmpty()
    assert found.agg(F.max("source_parts")).first()[0] > 1
