from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from rows import NASTY, changed, documents, groups, shingles, words

from muster.llm import forest_dedup
from muster.llm.common import Stage


def _brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    group = groups(sets, links)
    return {d: (len(sets[d]), group[d], group[d] == d) for d in sets}


def test_same_groups_as_brute_force(spark):
    """Copies, near copies, chains of near copies and a passage in half of all documents."""
    rng = random.Random(11)
    passage = words(rng, 60)
    rows, number = [], 0
    for size, length, share in ((40, 120, 0.01), (25, 60, 0.02), (6, 200, 0.02), (2, 30, 0.01), (2, 12, 0.05)):
        text = words(rng, length)
        for _ in range(size):
            rows.append((number, " ".join(changed(rng, text, share))))
            number += 1
            if rng.random() < 0.3:
                rows.append((number, rows[-1][1].upper().replace("W", "w")))
                number += 1
    step = words(rng, 150)
    for _ in range(12):  # each near the one before, the last far from the first
        step = changed(rng, step, 0.015)
        rows.append((number, " ".join(step)))
        number += 1
    for _ in range(120):
        own = words(rng, rng.randrange(20, 90))
        rows.append((number, " ".join(own[:10] + (passage if rng.random() < 0.5 else []) + own[10:])))
        number += 1
    rng.shuffle(rows)
    found = forest_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == _brute(rows)


def test_large_group_whose_neighbours_are_mostly_refuted(spark):
    rng = random.Random(11)
    base = words(rng, 400)
    rows = []
    for i in range(400):
        text = list(base)
        for at in rng.sample(range(len(text)), 7):
            text[at] = f"edit{i}-{at}"
        rows.append((i, " ".join(text)))
    found = forest_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == _brute(rows)


def test_many_near_copies_against_all_pairs(spark):
    """Eight thousand near copies of one text, half of their links missing: groups equal those of all pairs compared."""
    rng = np.random.default_rng(23)
    n, size = 8000, 120
    edits = rng.random((n, size)) < rng.choice([0.005, 0.02, 0.04], (n, 1))
    # Every edit is a word of its own, so shingles are common where neither text is edited.
    texts = [" ".join(f"e{i}-{k}" if e else f"w{k}" for k, e in enumerate(row)) for i, row in enumerate(edits)]
    whole = np.stack([~edits[:, k : size - 4 + k] for k in range(5)]).all(axis=0).astype(np.float32)
    common = whole @ whole.T
    sizes = size - 4
    linked = 100 * common >= 75 * (2 * sizes - common)
    parent = np.arange(n)
    changed_ = True
    while changed_:  # the smallest id that each id reaches
        lower = np.array([parent[row].min(initial=n) for row in linked])
        lower = np.minimum(lower, parent)
        changed_ = bool((lower != parent).any())
        parent = lower
    found = forest_dedup.near_duplicates(documents(spark, list(enumerate(texts)))).collect()
    got = {r.doc_id: r.component_id for r in found}
    assert sum(got[i] != parent[i] for i in range(n)) == 0
    assert len(set(got.values())) > 100


def test_edge_rows(spark):
    found = forest_dedup.near_duplicates(documents(spark, NASTY, clashing=True)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in found) == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
            (7, len(shingles(NASTY[6][1])), 7, True), (8, 2, 8, True), (8, 2, 8, True), (9, 6, 9, True), (9, 6, 9, True),
            (-1, 6, None, True), (-1, 0, None, True),
        ]
    )


def test_one_id_with_different_texts(spark):
    rng = random.Random(1)
    one, other = " ".join(words(rng, 40)), " ".join(words(rng, 40))
    near = " ".join([*other.split()[:-1], "end"])
    rows = [(1, one), (1, other), (2, one), (3, other), (4, near), (0, " ".join(words(rng, 40)))]
    found = forest_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1), (4, 1), (0, 0)}


def test_no_rows(spark):
    assert forest_dedup.near_duplicates(documents(spark, [])).isEmpty()


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    one, other = np.unique(base[:500]), np.unique(base[100:])
    share = (forest_dedup.minhashes([one])[0] == forest_dedup.minhashes([other])[0]).mean()
    assert abs(share - 400 / 600) < 0.12


def test_rows_of_a_small_crowd_travel_once(spark, monkeypatch):
    def travelled(similarity):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(5).cast(pa.int64())], ["a", "b"])

        return run

    monkeypatch.setattr(forest_dedup, "_compared", travelled)
    crowds = spark.createDataFrame([(bytearray(b"c"), i) for i in range(6)], "crowd binary, id long")
    groups = spark.createDataFrame([(i, 0) for i in range(3)], "id long, component_id long")
    sets = spark.createDataFrame([(i, [1, 2, 3 + i]) for i in range(6)], "id long, shingles array<long>")
    rows = forest_dedup._crowd_links(crowds, groups, sets, Stage(spark), 75).collect()
    assert sorted(r.a for r in rows) == list(range(6))
