from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pytest
from rows import NASTY, documents
from tokenizers import Tokenizer

from muster.llm import token_planes as tp
from muster.llm.common import Stage


@functools.cache
def _tokenizer():
    return Tokenizer.from_file(tp.TOKENIZER)


def _ids(text):
    ids = _tokenizer().encode(text or "", add_special_tokens=False).ids
    return [*ids, tp.END]


TEXTS = [
    "The Cat's <|endoftext|> <|ENDOFTEXT|> don't", "Σίσυφος ΟΔΥΣΣΕΥΣ İstanbul ﬁne", "a b c\u0085d\x1ce\x1ff",
    "é é Å Å", "日本語 テキスト 한국어", "tab\there\r\nnew  line   x", "😀👍🏽 ok!!! ???", "1234567890 3.14", '" "a "',
    "Éa! ÀÉÎÕÜ... straße, ÿÝþ×÷ µ ª º it's IT'S 's' o'clock' x'' don't!? e\u0301 ALL,CAPS (a) [b] <|startoftext|>, --end--",
]


def test_ids_equal_those_of_whole_texts():
    assert [np.frombuffer(b, "<u4").tolist() for b in tp.encode(TEXTS)] == [_ids(t) for t in TEXTS]


def test_ids_survive_forgetting(monkeypatch):
    monkeypatch.setattr(tp, "_REMEMBERED", 5)
    for texts in (TEXTS * 2, TEXTS[:3], TEXTS[2:], TEXTS):
        assert [np.frombuffer(b, "<u4").tolist() for b in tp.encode(texts)] == [_ids(t) for t in texts]


def test_ids_of_every_latin_letter_and_mark():
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    texts = [f"{c} a{c} {c}a a{c}a A{c}{c} a!{c} b{c}'s" for c in letters]
    assert [np.frombuffer(b, "<u4").tolist() for b in tp.encode(texts)] == [_ids(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 7, 65_536])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert (tp.from_planes(tp.to_planes(ids), n) == ids).all()


def test_joined_checksums():
    parts = [os.urandom(n) for n in (4, 400, 0, 65_536)]
    crcs, sizes = [zlib.crc32(p) for p in parts], [len(p) // 4 for p in parts]
    assert tp._join_all(crcs, sizes) == zlib.crc32(b"".join(parts))


def _expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in order:
        ids = _ids(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_round_trip_through_files(spark, monkeypatch, block):
    """Documents over many small blocks, and over few large ones."""
    monkeypatch.setattr(tp, "BLOCK", block)
    rows = [(n, "some words of text number %d " % n * (n % 23)) for n in range(300)]
    rows += [(1000, "long " * 3000)]
    found = sorted(tuple(r) for r in tp.round_trip(documents(spark, rows)).collect())
    assert found == _expected(rows)


def test_ids_are_in_the_files(spark):
    rows = [(n, f"text {n} of the files") for n in range(40)]
    stage = Stage(spark)
    tp.write(documents(spark, rows), f"{stage.folder}/planes")
    pieces = tp.read(spark, f"{stage.folder}/planes").collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pieces} == {n: _ids(t) for n, t in rows}


def test_edge_rows(spark):
    found = tp.round_trip(documents(spark, NASTY, clashing=True)).collect()
    ids = sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in found)
    assert ids == sorted((d or -1, n, c) for d, _, n, c in _expected(NASTY))
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert tp.round_trip(documents(spark, [])).isEmpty()
