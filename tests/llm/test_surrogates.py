from __future__ import annotations

import re
import time
from collections import Counter

from pyspark.sql import functions as F
from rows import NASTY, documents

from muster.llm import surrogates
from muster.llm.common import Stage

TEXT = (
    "Write to Anna.Miller@Mail.example.com or anna.miller@mail.example.com, call +1 (743) 555-3824 or 743-555-3824, "
    "host 114.203.152.12, card 4379362835490466 or 4379 3628 3549 0466. Frau Anna Schmidt met Herr Schmidt."
)


def _run(spark, rows, **kw):
    return surrogates.replace(documents(spark, rows, **kw))


def _luhn(digits):
    total = 0
    for place, d in enumerate(reversed([int(c) for c in digits]), 1):
        total += (d * 2 - 9 * (d > 4)) if place % 2 == 0 else d
    return total % 10


def test_types_formats_and_coreference(spark):
    (row,) = _run(spark, [(1, TEXT)]).collect()
    new = row.text
    for old in ("nna.", "Miller", "555-3824", "114.203", "43793628", "3628", "Schmidt", "Anna"):
        assert old not in new, old
    shape = re.match(
        r"Write to (\S+@\S+\.com) or (\S+@\S+\.com), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3}-\d{3}-\d{4}), "
        r"host (\d{3}\.\d{3}\.\d{3}\.\d{2}), card (\d{16}) or (\d{4} \d{4} \d{4} \d{4})\. "
        r"Frau (\w+) (\w+) met Herr (\w+)\.$",
        new,
    )
    assert shape, new
    one, two, a, b, c, phone, host, card, spaced, given, family, again = shape.groups()
    assert one != two and one.lower() == two  # one address, written in two ways
    assert [x.isupper() for x in one] == [x.isupper() for x in "Anna.Miller@Mail.example.com"]
    assert card == spaced.replace(" ", "") and card[0] == "4" and _luhn(card) == _luhn("4379362835490466")
    assert all(0 <= int(x) <= 255 for x in host.split("."))
    assert family == again and given != family
    assert given.lower().endswith(surrogates._ENDINGS["given_f"][0])
    assert dict(row.found) == {"email": 2, "ip": 1, "phone": 2, "card": 2, "name": 2}


def test_script_and_gender(spark):
    (row,) = _run(spark, [(1, "Госпожа Анна Иванова и Господин Борис Иванов, Herr Max Muster")]).collect()
    first, second, third = re.match(r"Госпожа (\w+ \w+) и Господин (\w+ \w+), Herr (\w+ \w+)$", row.text).groups()
    assert re.fullmatch(r"[а-яА-Я]+ [а-яА-Я]+а", first) and re.fullmatch("[а-яА-Я]+ [а-яА-Я]+", second)
    assert third.isascii() and third.split()[0].lower().endswith(surrogates._ENDINGS["given_m"][0])


def test_one_entity_one_surrogate_and_no_clash(spark):
    """Thousands of addresses: all surrogates differ, none is an address of the documents, and reruns agree."""
    rows = [(n, f"host 10.0.{n // 250}.{n % 250} card {4000000000000000 + n} mail u{n % 997}@x.org") for n in range(3000)]
    new = {r.doc_id: r.text for r in _run(spark, rows).collect()}
    hosts = {n: re.search(r"host (\S+)", t)[1] for n, t in new.items()}
    assert len(set(hosts.values())) == 3000
    assert not set(hosts.values()) & {f"10.0.{n // 250}.{n % 250}" for n in range(3000)}
    assert all(h.startswith("10.") for h in hosts.values())  # private stays private
    mails = {}
    for n, t in new.items():
        assert mails.setdefault(n % 997, t.split()[-1]) == t.split()[-1]
    assert len(set(mails.values())) == 997
    again = {r.doc_id: r.text for r in _run(spark, rows[::-1]).collect()}
    assert again == new


def test_clashes_are_resolved(spark):
    """In a crowded space first attempts clash; the result has no clash left."""
    entities = spark.range(3000).select(
        F.lit("ip").alias("kind"), F.concat(F.lit("192.168."), (F.col("id") % 100 + 10).cast("string"), F.lit("."), (F.floor(F.col("id") / 100) + 100).cast("string")).alias("entity"),
    )
    found = surrogates.assign(entities, Stage(spark))
    assert found.count() == 3000 and found.select("surrogate").distinct().count() == 3000
    assert found.join(entities.select(F.col("entity").alias("surrogate")), "surrogate").isEmpty()


def _assigned(spark, pairs):
    entities = spark.createDataFrame(pairs, "kind string, entity string")
    found = [(r.kind, r.entity, r.surrogate) for r in surrogates.assign(entities, Stage(spark)).collect()]
    assert sorted(f[:2] for f in found) == sorted(pairs)
    assert len({(kind, new) for kind, _, new in found}) == len(found)
    assert all(old != new for _, old, new in found)
    return {(kind, old): new for kind, old, new in found}


def test_full_formats_are_permuted(spark):
    """All addresses of a small network, all one-letter boxes of a domain, all one-letter domains, many names."""
    network = [("ip", f"192.168.{a}.{b}") for a in range(10) for b in range(10)]
    more = [("ip", f"10.{a}.{b}.1") for a in range(10) for b in range(10)] + [("ip", f"192.{a}.77.{b}") for a in (167, 168, 169) for b in (1, 2)]
    odd = [("ip", "01.002.300.999"), ("ip", "11.0.0.0"), ("ip", "9.0.0.0"), ("ip", "191.1.1.1"), ("ip", "193.1.1.1"), ("ip", "224.1.1.1")]
    boxes = [("email", f"{c}@x.org") for c in "abcdefghijklmnopqrstuvwxyz"]
    domains = [("domain", f"{c}.org") for c in "abcdefghijklmnopqrstuvwxyz0123456789"]
    numbers = [("phone", f"2{n:09d}") for n in range(40)] + [("card", f"4{n:012d}") for n in range(40)]
    names = [("family", f"name{n}") for n in range(6000)] + [("given_f", f"name{n}") for n in range(2000)]
    found = _assigned(spark, network + more + odd + boxes + domains + numbers + names)
    for _, old in network:
        assert re.fullmatch(r"192\.168\.\d\.\d", found["ip", old])
    for kind, old in more + odd:
        new = found[kind, old]
        assert [len(x) for x in new.split(".")] == [len(x) for x in old.split(".")]
        assert new.startswith("10.") == old.startswith("10.") and new.startswith("192.168.") == old.startswith("192.168.")
    assert {found["email", f"{c}@x.org"] for c in "abc"} <= {e for _, e in boxes}
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        assert found["domain", f"{c}.org"][0].isalpha() == c.isalpha()


def test_addresses_of_marks_are_left_alone(spark):
    rows = [(1, "see ---@-.- there"), (2, "a@-.org and -@b.org and ..@..com"), (3, "x.-y@-a-.com")]
    found = {r.doc_id: r for r in _run(spark, rows).collect()}
    assert found[1].text == rows[0][1] and not any(found[1].found.values())
    assert re.fullmatch(r"[b-z]@-\.org and -@b\.org and \.\.@\.\.com", found[2].text)
    assert re.fullmatch(r"[a-wyz]\.-[a-xz]@-[b-z]-\.com", found[3].text)


def test_small_networks_in_texts(spark):
    rows = [(n, f"host 192.168.{n // 10}.{n % 10} up") for n in range(100)]
    new = {r.doc_id: r.text for r in _run(spark, rows).collect()}
    assert len(set(new.values())) == 100 and set(new.values()) == {text for _, text in rows}
    assert all(new[n] != text for n, text in rows)


def test_short_domains_stay_apart(spark):
    rows = [(n, f"to me@{chr(97 + n)}.io") for n in range(26)]
    new = {r.text.split("@")[1] for r in _run(spark, rows).collect()}
    assert len(new) == 26


def test_finds_equal_an_independent_detector(spark):
    """Every address, number and titled name that plain Python finds in the documents is replaced, and nothing else is changed."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds = {
        "email": r"(?<![\w.%+-])[\w.%+-]*[A-Za-z0-9][\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
        "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        "card": r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
    }
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    found = {r.doc_id: r for r in surrogates.replace(docs).collect()}
    seen = Counter()
    for doc_id, text in before.items():
        new = found[doc_id].text or ""
        for kind, pattern in kinds.items():
            values = re.findall(pattern, text)
            assert found[doc_id].found[kind] == len(values), (doc_id, kind, values)
            assert not [v for v in values if re.search(rf"(?<![\w.]){re.escape(v)}(?![\w])", new)], (doc_id, kind)
            seen[kind] += len(values)
        if not any(found[doc_id].found.values()):
            assert new == text
        else:
            shape = lambda t: re.sub("[A-Za-z]", "a", re.sub("[0-9]", "0", t))
            if not found[doc_id].found["name"]:
                assert shape(new) == shape(text)
    assert min(seen[kind] for kind in kinds) > 0


def test_many_matches_in_one_text(spark):
    text = " ".join(f"user{n}@example{n % 50}.org" for n in range(16_000))
    began = time.time()
    (row,) = _run(spark, [(1, text)]).collect()
    assert time.time() - began < 60
    assert row.found["email"] == len(set(row.text.split())) == 16_000


def test_key_decides(spark):
    docs = documents(spark, [(1, TEXT)])
    assert surrogates.replace(docs, key="one").first().text != surrogates.replace(docs, key="two").first().text


def test_clean_texts_stay(spark):
    clean = ["Version 1.2.3.4.5 of 2024-01-15", "a@b", "@x.org", "12 345", "Mr. smith", "1234567890123456789012345", "x" * 50_000]
    found = {r.doc_id: r.text for r in _run(spark, list(enumerate(clean))).collect()}
    assert found == dict(enumerate(clean))


def test_edge_rows(spark):
    rows = [*NASTY, (20, TEXT), (20, TEXT), (None, TEXT), (21, "Frau Ann " * 20_000)]
    docs = documents(spark, rows, clashing=True)
    found = surrogates.replace(docs)
    assert set(found.columns) == set(docs.columns)  # found is replaced
    texts = {}
    for r in found.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    assert sum(map(len, texts.values())) < len(rows)
    assert texts[1] == {None} and texts[2] == {""} and texts[9] == {"a b c d e f g h i j"}
    assert len(texts[20]) == 1 and texts[20] < texts[None]
    assert found.count() == len(rows)
    assert surrogates.replace(documents(spark, [])).isEmpty()
