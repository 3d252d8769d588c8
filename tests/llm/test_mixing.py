from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from rows import NASTY, documents

from muster.llm import mixing


def _sizes(spark, sizes):
    return spark.createDataFrame(list(sizes.items()) or [], "source string, source_size long")


def _brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(order)}
    total = sum(sizes.values())
    target, free = {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] >= 3 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 3.0 * sizes[s]
        free -= above
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, "d": 5, None: 70},
        {"a": 0, "b": 10},
        {"a": 7},
        {"z": 3, "é": 900, "A": 40, "m": 40, "n": 1, "o": 2},
        {"a": 0},
    ],
)
def test_targets_equal_resharing_step_by_step(spark, sizes):
    found = {r.source: r.target for r in mixing.targets(_sizes(spark, sizes)).collect()}
    expected = _brute_targets(sizes)
    assert found.keys() == expected.keys()
    for source in found:
        assert found[source] == pytest.approx(expected[source])


def _docs(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))
        ).alias("source"),
    )


def test_each_source_fills_its_target(spark):
    docs = _docs(spark)
    quality = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")).filter("doc_id % 4 < 3")
    mixed = mixing.mix(docs, quality)
    rows = mixed.collect()
    assert len(rows) == 3000 and all(r.taken <= 3 * r.size for r in rows)
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert sum(r.taken for r in mine) == round(mine[0].target)
        assert mine[0].source_size == sum(r.size for r in mine)
        epochs = {r.taken // r.size for r in mine if r.size}
        assert len(epochs) <= 2  # whole epochs before a part of one
    assert Counter(map(tuple, mixing.mix(docs.repartition(7), quality).collect())) == Counter(map(tuple, rows))


def test_better_documents_come_first(spark):
    docs = _docs(spark).filter("size(split(text, ' ')) > 1")
    quality = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    rows = mixing.mix(docs, quality).withColumn("more", F.col("taken") / F.col("size")).groupBy("weight").agg(F.avg("more"))
    share = {r[0]: r[1] for r in rows.collect()}
    assert share[2.0] > share[0.5]


def test_edge_rows(spark):
    docs = documents(spark, NASTY, clashing=True)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(NASTY)
    assert {r.doc_id: r.size for r in rows if r.doc_id in (1, 2, 3, 4, 8)} == {1: 0, 2: 0, 3: 0, 4: 3, 8: 30_001}
    assert sum(r.taken for r in rows) == rows[0].source_size == rows[0].target
    assert mixing.mix(documents(spark, [])).isEmpty()
    only_empty = mixing.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.taken, r.target) for r in only_empty] == [(0, 0.0), (0, 0.0)]


def test_repeat_keeps_columns(spark):
    docs = documents(spark, [(n, "w " * (n % 9 + 1)) for n in range(50)], clashing=True)
    taken = mixing.repeat(docs)
    assert taken.columns == docs.columns
    assert taken.count() == 50  # one source: one epoch of everything
