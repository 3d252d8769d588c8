from __future__ import annotations

import math

import numpy as np
from rows import groups

from muster.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int"


def _run(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return nn_descent.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept", "audit_recall")


def _brute(rows):
    unit = {}
    for i, v, label in rows:
        x = np.array(v, np.float64)
        unit[i] = (x / np.linalg.norm(x), label)
    links = [
        (i, j) for i in unit for j in unit if i < j and unit[i][1] == unit[j][1] and unit[i][0] @ unit[j][0] >= 0.98
    ]
    degree = {i: sum(i in link for link in links) for i in unit}
    group = groups(unit, links)
    return {i: (degree[i], group[i], i == group[i]) for i in unit}


def test_same_links_as_brute_force(spark):
    """Groups of near copies of two to sixty, chains of near copies, scaled copies and noise, under two labels."""
    rng = np.random.default_rng(5)
    rows, number = [], 0
    for label, sizes in ((1, [60, 12, 5, 2, 2]), (2, [30, 3])):
        for size in sizes:
            centre = rng.standard_normal(16)
            for _ in range(size):
                near = centre + rng.standard_normal(16) * 0.12
                rows.append((number, (near * rng.uniform(0.5, 3)).astype(np.float32).tolist(), label))
                number += 1
        for _ in range(150):
            rows.append((number, rng.standard_normal(16).astype(np.float32).tolist(), label))
            number += 1
    found = _run(spark, rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == _brute(rows)
    assert {r.audit_recall for r in found} == {1.0}


def _tight_groups():
    """Two groups of 300 with inner cosines near 0.9975, most cosines between them just above the threshold."""
    rng = np.random.default_rng(3)
    a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
    other = 0.9845 * a + math.sqrt(1 - 0.9845**2) * b
    x = np.concatenate([centre + rng.standard_normal((300, 64)) * 0.05 / 8 for centre in (a, other)]).astype(np.float32)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    return x, unit


def test_weak_links_join_tight_groups(spark):
    x, unit = _tight_groups()
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    found = _run(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)]).collect()
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(near.sum(axis=1).tolist()))
    assert {r.component_id for r in found} == {0}


def test_comparing_all_finds_what_no_list_holds(spark):
    x, unit = _tight_groups()
    rows = [(i, 1, u.tobytes()) for i, u in enumerate(unit)]
    vectors = spark.createDataFrame(rows, "id long, label int, unit binary")
    apart = spark.createDataFrame([(i, 0 if i < 300 else 300) for i in range(600)], "id long, component_id long")
    found = nn_descent._compare_all(vectors, apart, 0.98).collect()
    assert any((r.v < 300) != (r.u < 300) for r in found)


def test_labels_are_told_apart(spark):
    """Labels whose hashes are equal in Python, in one partition."""
    kinds = [-1, -2, 0, 2**61 - 1, 1, 2**61]
    rows = [(10 * n + k, [1.0, 2.0 + k / 100, 3.0], kind) for n, kind in enumerate(kinds) for k in range(2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").coalesce(1)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = nn_descent.near_duplicates(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == {(10 * n + k, 1, 10 * n) for n in range(6) for k in range(2)}


def test_one_id_with_several_vectors(spark):
    """Copies of each of its vectors are found; links are counted by row, labels stay apart."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, a, 1), (5, b, 1), (5, c, 2), (6, a, 1), (7, b, 1), (3, c, 2), (8, c, 1), (9, [0.0, 1.0, 0.01], 1), (2, a, 3)]
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in _run(spark, rows).collect())
    assert found == sorted([(5, 1, 3), (5, 2, 3), (5, 1, 3), (6, 1, 3), (7, 2, 3), (3, 1, 3), (8, 0, 8), (9, 2, 3), (2, 0, 2)])


def test_lone_pairs_among_many(spark):
    """Two hundred pairs just above the threshold among 20,000 unrelated vectors, by an audit with evidence."""
    rng = np.random.default_rng(17)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.standard_normal((200, 64))
    aside -= (aside * x[:200]).sum(axis=1)[:, None] * x[:200]
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    x[200:400] = 0.982 * x[:200] + math.sqrt(1 - 0.982**2) * aside
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    rows = nn_descent.near_duplicates(df).collect()
    assert {r.vec_id: r.component_id for r in rows if r.vec_id != r.component_id} == {i + 200: i for i in range(200)}
    assert {r.n_links for r in rows if r.vec_id < 400} == {1} and {r.n_links for r in rows if r.vec_id >= 400} == {0}
    assert rows[0].audit_links >= 190 and rows[0].audit_recall >= nn_descent.RECALL


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)], SCHEMA)
    from pyspark.sql import functions as F

    odd = df.withColumns({name: F.lit("own") for name in ("id", "unit", "copies", "component_id", "n_links", "first_id", "v", "u", "kept")})
    assert sorted(tuple(r)[:4] for r in nn_descent.near_duplicates(odd).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [1.0, math.nan, 3.0], 1), (10, [1.0, math.inf, 3.0], 1), (11, [1.0, 2.0], 1),
        (None, v, 1), (12, [1e-30, 2e-30, 3e-30], 1),
    ]
    found = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in _run(spark, rows).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert found == sorted(
        [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (12, 3, 1, False), (-1, 0, None, True), *alone]
    )


def test_no_rows_and_other_labels(spark):
    assert _run(spark, []).isEmpty()
    named = _run(spark, [(1, [1.0, 0.0], "x"), (2, [1.0, 0.01], "x")], "vec_id long, embedding array<double>, label string")
    assert sorted(tuple(r)[:3] for r in named.collect()) == [(1, 1, 1), (2, 1, 1)]
