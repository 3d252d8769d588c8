from __future__ import annotations

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from rows import NASTY, documents

from muster.llm import importance
from muster.llm.common import Stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _brute(docs, target, buckets=10_000):
    def counted(texts):
        counts = [0] * buckets
        for text in texts:
            for f in _features(text)[1]:
                counts[crc32(f.encode()) % buckets] += 1
        return counts

    s, t = counted([t for _, t in docs]), counted(target)
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        words, features = _features(text)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words), len(features), weight, score, None])
    eligible = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: 25 * len(eligible) // 100], start=1):
        row[5] = rank
    return sorted(map(tuple, rows), key=repr)


def _found(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def _texts(rng, n):
    vocabulary = ["A", "b", "Ünï", "ÇÖDE", "x9", "日本", "the"] + [f"w{i}" for i in range(400)]
    gaps = [" ", "-", "`", "\n", "\x7f", "{", ":", "  ", "\x00"]
    return [rng.choice(["", " "]) + "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 60]))) for _ in range(n)]


def test_equal_to_brute_force(spark):
    rng = random.Random(9)
    docs = list(enumerate(_texts(rng, 400))) + NASTY
    target = _texts(rng, 30) + [None, ""]
    target_df = spark.createDataFrame([(t,) for t in target], "text string")
    expected = _brute(docs, target)
    assert _found(importance.resample(documents(spark, docs, clashing=True).repartition(5), target_df)) == expected


def test_small_portions_change_nothing(spark, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": ["ab " * n for n in (0, 5, 900, 1, 2, 3, 4)] + [None]})
    monkeypatch.setattr(importance, "SLICE_BYTES", 30)
    monkeypatch.setattr(importance, "SLICE_ROWS", 2)
    parts = list(importance.portions(iter([batch])))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) == 5
    whole = np.bincount(importance.features(batch.column("text"))[2], minlength=10_000)
    cut = sum(np.bincount(importance.features(p.column("text"))[2], minlength=10_000) for p in parts)
    assert (whole == cut).all()


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(n, "one two " * 15) for n in range(8)])
    assert importance.resample(none, some).collect() == []
    assert importance.resample(none, none).collect() == []
    rows = _found(importance.resample(some, none))
    assert rows == _brute([(n, "one two " * 15) for n in range(8)], [])
    assert sum(r[5] is not None for r in rows) == 2


def test_ranks_of_one_key(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 90).alias("score"),
    )
    found = importance.ranked(rows.repartition(6), Stage(spark)).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 4001))
    assert [(r.score, r.doc_id) for r in found] == [tuple(x) for x in sorted(((r.score, r.doc_id) for r in found), key=lambda x: (-x[0], x[1]))]


def test_target_like_documents_are_drawn(spark):
    rng = random.Random(4)
    near = [" ".join(f"t{rng.randrange(200)}" for _ in range(60)) for _ in range(300)]
    far = [" ".join(f"o{rng.randrange(200)}" for _ in range(60)) for _ in range(900)]
    target = spark.createDataFrame([(" ".join(f"t{rng.randrange(200)}" for _ in range(60)),) for _ in range(100)], "text string")
    docs = documents(spark, list(enumerate(near + far)))
    drawn = importance.resample(docs, target).filter("rank is not null")
    assert drawn.count() == 300
    assert drawn.filter("doc_id < 300").count() > 150  # 75 by chance
