from __future__ import annotations

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from rows import NASTY, documents

from muster.llm import context_mixing as cm

DIRECTORY = "/root/testdata/sf0.001"


def _learned(texts):
    data = [cm._bytes(t) for t in texts]
    symbols, coded = cm._symbols(data)
    pairs = Counter((symbols[:-1].astype(int) * cm._SYMBOLS + symbols[1:])[coded[1:]].tolist())
    code = cm.Code(pairs)
    _, slots, bits, _ = code.decisions(data)
    seen = np.zeros((len(cm.ORDERS), cm._SLOTS, 2))
    for k, slot in enumerate(slots):
        np.add.at(seen[k], (slot[bits < 2], bits[bits < 2]), 1)
    return code, cm._sixteenths(np.log((seen[..., 1] + 0.4) / (seen[..., 0] + 0.4)))


def test_every_code_is_a_complete_prefix_code():
    """The lengths of each byte's codes add up to one, and no two codes agree."""
    code = cm.Code({ord("a") * cm._SYMBOLS + ord(b): 9 for b in "bcd"})
    for before in (0, ord("a"), cm._START):
        rows = range(before * cm._SYMBOLS, before * cm._SYMBOLS + cm._END + 1)
        assert sum(2.0 ** -int(code.length[r]) for r in rows) == 1
        codes = {tuple(code.nodes[code.offset[r] : code.offset[r] + code.length[r]] & 1) for r in rows}
        assert len(codes) == cm._END + 1


def test_probabilities_of_all_continuations_add_up_to_one():
    """A proper model: over all texts of two letters' alphabet and one length, with everything else, at most one."""
    code, tables = _learned(["abba baab abab"] * 20)
    texts = [x + y for x in ("", "a", "b") for y in ("a", "b", "c")] + [""]
    total = sum(10 ** s for s in cm.score([t.encode() for t in texts], code, tables))
    assert 0 < total <= 1


def test_score_equals_bit_by_bit_mixing():
    """The vectorised mixing against one bit after the other."""
    texts = ["the cat sat on the mat and the dog sat on the log " * n for n in (1, 3, 40)] + ["", "zq"]
    code, tables = _learned(texts[:2])
    found = cm.score([t.encode() for t in texts], code, tables)
    for text, score in zip(texts, found, strict=True):
        inputs, bits, _ = code.inputs([text.encode()], tables)
        bits = bits[bits < 2]
        total, segment = 0.0, cm.SEGMENT * cm.STEP
        for low in range(0, len(bits), segment):
            weights = np.full((3, len(inputs)), cm.FIRST_WEIGHT)
            bias, gate = np.zeros(3), 0
            for at in range(low, min(low + segment, len(bits)), cm.STEP):
                high = min(at + cm.STEP, len(bits))
                x = np.array([column[at:high] for column in inputs], np.float64) / cm.SCALE
                p = 1 / (1 + np.exp(-(weights[gate] @ x + bias[gate])))
                y = bits[at:high]
                cost = -np.log(np.where(y, p, 1 - p)).sum()
                weights[gate] += cm.RATE * (x @ (y - p))
                bias[gate] += cm.RATE * (y - p).sum()
                gate, total = int(np.searchsorted(cm.GATES, cost / cm.STEP)), total - cost
        assert score == pytest.approx(total / np.log(10), rel=1e-3, abs=1e-3)


def _base(rows):
    """The unigram part by the contract's words."""
    tokens = {n: (t or "").encode().lower().split() for n, (_, t) in enumerate(rows)}
    ids = {n: d for n, (d, _) in enumerate(rows)}
    held = {n: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for n, d in ids.items()}
    learned = [n for n in tokens if ids[n] is not None and not held[n]]
    counts = Counter(w for n in learned for w in tokens[n])
    counts[None] = len(learned)  # the end
    total, kinds = sum(counts.values()), sum(c > 0 for c in counts.values())
    out = []
    for n, found in tokens.items():
        c = [counts[w] for w in [*found, None]]
        base = sum(log10((x + 1) / (total + kinds + 1)) for x in c)
        out.append((ids[n] or -1, held[n], len(c), sum(x > 0 for x in c), total, base))
    return sorted(out)


@pytest.mark.parametrize("sent", [cm.SENT_TOKENS, 3])
def test_base_scores(spark, monkeypatch, sent):
    """With most tokens sent along, and with most of them joined."""
    monkeypatch.setattr(cm, "SENT_TOKENS", sent)
    rows = [*NASTY, *[(n, f"Common word {n % 5} and rare{n} rare{n}") for n in range(20, 60)]]
    found = cm.score_corpus(documents(spark, rows, clashing=True)).collect()
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    for a, b in zip(got, _base(rows), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(r.score < 0 for r in found)


def test_empty_and_unlearned(spark):
    assert cm.score_corpus(documents(spark, [])).isEmpty()
    (row,) = cm.score_corpus(documents(spark, [(None, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.score < 0


def test_held_out_texts_cost_less_than_by_order_one_code(spark):
    """The mixed contexts predict texts that were not learned better than one bit per decision."""
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "text")
    rows = [r for r in cm.score_corpus(docs).collect() if r.held_out]
    size = sum(r.n_bytes for r in rows)
    assert rows and -sum(r.score for r in rows) / log10(2) / size < 3.3
