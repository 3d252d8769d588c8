from __future__ import annotations

import random

from rows import NASTY, documents, shingles, words

from muster.llm import containment


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def _run(spark, docs, items):
    return sorted(tuple(r) for r in containment.contaminated(docs, _items(spark, items)).collect())


def _brute(docs, items):
    out = set()
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            want = shingles(item)
            common = len(want & have)
            if want and 100 * common >= 75 * len(want):
                out.add((d, i, common, len(want)))
    return sorted(out)


def test_same_matches_as_brute_force(spark):
    """Short items inside long documents, whole, cut, changed and split in two, against items of many sizes."""
    rng = random.Random(2)
    items = [(n, " ".join(words(rng, rng.choice([3, 5, 7, 15, 40, 90, 200])))) for n in range(40)]
    docs = [(100, items[0][1])]
    for n in range(150):
        text = words(rng, rng.randrange(20, 3000))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split()
            cut = rng.randrange(len(part) // 3 + 1)
            if rng.random() < 0.3 and len(part) > 20:
                part[len(part) // 2] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = part[cut:]
        docs.append((n + 200, " ".join(text)))
    expected = _brute(docs, items)
    assert len(expected) > 50
    assert _run(spark, documents(spark, docs), items) == expected


def test_edge_rows(spark):
    items = [(1, "a b c d e f g"), (2, "one two three"), (3, None), (4, ""), (None, "a b c d e"), (5, "A B C D E F G")]
    found = containment.contaminated(documents(spark, NASTY, clashing=True), _items(spark, [*items, items[0]])).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.common, r.item_shingles) for r in found) == sorted(
        [(d, i, 3, 3) for d in (9, -1) for i in (1, 5)] + [(4, 2, 1, 1), (5, 2, 1, 1)]
    )


def test_no_rows(spark):
    assert _run(spark, documents(spark, []), [(1, "a b c d e")]) == []
    assert _run(spark, documents(spark, NASTY), []) == []


def test_one_scan_for_any_number_of_items(spark):
    """Hundreds of items of all sizes: the documents are read once, no row of the benchmark reaches the driver."""
    rng = random.Random(6)
    items = [(n, " ".join(words(rng, rng.randrange(3, 120), 900))) for n in range(600)]
    docs = [(n, " ".join([*words(rng, 50, 900), items[3 * n][1], items[n][1], *words(rng, 900, 900)])) for n in range(120)]
    found = containment.contaminated(documents(spark, docs), _items(spark, items))
    assert sorted(tuple(r) for r in found.collect()) == _brute(docs, items)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan  # texts were read before, into a staged table


def test_ids_with_several_texts(spark):
    docs = [(1, "a b c d e f g h"), (1, "x y z x y z x y"), (None, "a b c d e f g h")]
    items = [(7, "a b c d e f"), (7, "x y z x y z x y w v"), (8, "x y z x y z")]
    found = containment.contaminated(documents(spark, docs * 2), _items(spark, items)).collect()
    assert {tuple(r) for r in found} == {(1, 7, 2, 2), (1, 8, 2, 2), (None, 7, 2, 2)} and len(found) == 3


def test_full_marks_lose_nothing(spark, monkeypatch):
    """With marks that are nearly all set every value is looked up by the join."""
    pages = containment.Marks.__init__

    def full(self, given):
        pages(self, {number: b"\xff" * len(raw) for number, raw in given.items()})

    monkeypatch.setattr(containment.Marks, "__init__", full)
    rng = random.Random(3)
    items = [(n, " ".join(words(rng, rng.randrange(4, 60)))) for n in range(20)]
    docs = [(n, " ".join([*words(rng, 30), items[n % 20][1], *words(rng, 100)])) for n in range(40)]
    assert _run(spark, documents(spark, docs), items) == _brute(docs, items)
