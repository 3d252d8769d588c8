from __future__ import annotations

import hashlib
import random
import re

import pytest
from rows import NASTY, documents

from muster.llm import fill_in_middle as fim


def _brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, output, chars = "plain", text, (None, None)
    else:
        form = "spm" if h4 % 100 < 20 else "psm"
        head = f"<S>{suffix}<P>{prefix}" if form == "spm" else f"<P>{prefix}<S>{suffix}"
        output, chars = f"{head}<M>{middle}", (len(prefix), len(middle))
    return doc_id, n, form, *chars, output


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    (n, text)
    for n, text in enumerate(
        ["", None, "a", "<", "<P>", "a<S>b", "x <M", "<<P", "é<é<S", "a1b2 c3", "Ünï ÇÖDE\u0085\n\t", "0" * 50, "ab" * 50, "<" * 40, "P>" * 9]
        + ["ab c, d<P e<S f<M> g" * k for k in range(4)]
        + ["word 12 \U0001f600 <S <M <P " * 700]
    )
]


def test_equal_to_whole_texts(spark):
    rows = TEXTS + [(n + 1000, "one two, three <four> five\n" * (n % 7)) for n in range(150)] + NASTY
    docs = documents(spark, rows, clashing=True)
    expected = []
    for doc_id, text in rows:
        *head, output = _brute(doc_id, text)
        expected.append((*head, _sha(output), _sha(text or "")))
    for partitions, units in ((None, fim.UNITS), (3, 5), (7, 1)):
        found = sorted(map(tuple, fim.digests(docs, partitions, units).collect()), key=repr)
        assert found == sorted(expected, key=repr)
    assert {row[2] for row in expected} == {"plain", "psm", "spm"}


def test_outputs_are_the_pieces_in_order(spark):
    rows = TEXTS + [(n + 1000, "one two, three <four> five\n" * 9) for n in range(30)]
    got = fim.outputs(documents(spark, rows), 3, 4).collect()
    texts = {}
    for r in got:
        texts.setdefault((r.row, r.doc_id), []).append(r.piece)
    assert sorted((doc_id, "".join(pieces)) for (_, doc_id), pieces in texts.items()) == sorted((d, _brute(d, t)[-1]) for d, t in rows)


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_sections_of_an_output_cut_anywhere(form):
    rng = random.Random(7)
    for _ in range(300):
        parts = {s: "".join(rng.choice("<>PSMé x") for _ in range(rng.randrange(9))) for s in "PSM"}
        if any(m.decode() in t for m in fim.MARKS.values() for t in parts.values()):
            continue
        output = b"".join(fim.MARKS[s] + parts[s].encode() for s in fim.FORMS[form])
        ends = sorted({0, len(output), *(rng.randrange(len(output)) for _ in range(6))})
        found = dict.fromkeys("PSM", b"")
        for section, piece in fim.sections(form, [output[a:b] for a, b in zip(ends, ends[1:], strict=False)]):
            found[section] += piece
        assert found == {s: t.encode() for s, t in parts.items()}


def test_units_over_block_borders(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("abZ 1é") for _ in range(rng.randrange(60)))
        starts = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        for units in (1, 3, 4096):
            marks, n = fim.unit_marks(text, units)
            assert (marks, n) == (starts[::units], len(starts))
            assert [fim.unit_offset(text, marks, n, u, units) for u in range(n + 1)] == [*starts, len(text)]


def test_no_rows(spark):
    assert fim.digests(documents(spark, [])).collect() == []


def test_texts_cross_the_network_once(spark):
    lineage = fim.digests(documents(spark, TEXTS))._jdf.queryExecution().toRdd().toDebugString()
    assert lineage.count("ShuffledRDD") == 1


def test_copies_of_one_id_are_spread(spark):
    docs = documents(spark, [(5, "same text here")] * 400).repartition(4)
    parts = fim.assembled(docs, 8).glom().map(len).collect()
    assert max(parts) < 2 * sum(parts) / 8
