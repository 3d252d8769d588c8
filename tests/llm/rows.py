"""Small tables for the operators' tests."""

from __future__ import annotations

import random

#: Columns that the operators use inside; documents may bring columns of these names.
CLASHING = ["id", "a", "b", "label", "labels", "blob", "found", "row", "key", "size", "slot", "copies", "carried", "lang_pred"]

NASTY = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one two three"),
    (5, "one two three"),
    (6, "!!! ... 42"),
    (7, " x y z\u0085 Ünï ÇÖDE straße"),
    (8, "word " * 30_000 + "end"),
    (8, "word " * 30_000 + "end"),
    (9, "a b c d e f g h i j"),
    (9, "a b c d e f g h i j"),
    (None, "a b c d e f g h i j"),
    (None, None),
]


def documents(spark, rows, clashing: bool = False):
    """(doc_id, text) rows as documents, with the other columns null or, if asked for, columns of clashing names."""
    made = [(d, t, "en", "s1", 0) for d, t in rows]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})
    return df


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def changed(rng: random.Random, text: list[str], share: float) -> list[str]:
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text]


def shingles(text: str | None, size: int = 5) -> set:
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def groups(ids, links) -> dict:
    """The smallest id that each id reaches."""
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent}
