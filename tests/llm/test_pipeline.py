from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from rows import NASTY, documents, groups, shingles, words
from tokenizers import Tokenizer

import corpus_pipeline
from muster.llm import token_planes

SMALL = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "tokens",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small folder of documents, labels and benchmark items."""
    rng = random.Random(4)
    items = [" ".join(words(rng, 20)) for _ in range(3)]
    rows = []
    for n in range(60):
        text = words(rng, rng.randrange(30, 80))
        if n % 10 == 3:
            text[5:5] = items[n % 3].split()
        rows.append((n, " ".join(text)))
        if n % 4 == 0:
            rows.append((1000 + n, rows[-1][1]))
        if n % 6 == 0:
            rows.append((2000 + n, rows[-1][1] + " tail"))
    rows += [(3000, None), (3001, ""), (3002, "123 !!!")]
    path = tmp_path_factory.mktemp("corpus")
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(n, n % 2, 0) for n in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), dict(rows), items


def test_whole_pipeline_by_brute_force(spark, folder):
    path, rows, items = folder
    left = {d: t for d, t in rows.items() if t and any(map(str.isalpha, t))}
    sets = {d: shingles(t) for d, t in left.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    left = {d: left[d] for d, g in groups(sets, links).items() if d == g}
    wanted = [shingles(i) for i in items]
    left = {d: t for d, t in left.items() if not any(100 * len(w & sets[d]) >= 75 * len(w) for w in wanted)}
    assert 30 < len(left) < 60
    # One source: the mix takes each document once. The last by key may be cut, but stays if half of it is taken.
    found = corpus_pipeline.run(spark, path).collect()
    assert sorted(r.doc_id for r in found) == sorted(left)
    tokenizer, start = Tokenizer.from_file(token_planes.TOKENIZER), 0
    for r in sorted(found, key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(left[r.doc_id], add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_take_edge_rows(spark, name):
    docs = documents(spark, NASTY, clashing=True)
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, docs, SMALL).columns == docs.columns
    assert stage(spark, docs.limit(0), SMALL).isEmpty()


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, NASTY), SMALL)
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 2})


def test_language_stage_drops_texts_without_letters(spark):
    kept = corpus_pipeline.identify_language(spark, documents(spark, [*NASTY, *[(n, f"some words {n}") for n in range(20, 40)]]), SMALL)
    assert {1, 2, 3, 6} & {r.doc_id for r in kept.collect()} == set()
    assert kept.count() == 20 + len(NASTY) - 5
