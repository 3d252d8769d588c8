"""Runs that die, meet others or are repeated: no order, id or link twice, and none lost."""

from __future__ import annotations

import csv
import glob
import io
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from crm_rows import OPTION_GROUPS, option, values
from pyspark.sql import functions as F

from muster.functions.text import csv_line
from muster.plans.exports import ORDER_KEYS
from muster.sinks import append, files, follow_up, ids, ledger, place, runs, storage
from muster.sources.derived import DerivedTables
from muster.sources.local import local_rows
from muster.sources.tables import routes

AS_OF = datetime(2001, 7, 15, 12)
SETTING = '{"default":{"file":"d","remote":"x/"},"1":{"file":"one","remote":"y/"},"03":{"file":"three","remote":"z/"}}'
NOW = timedelta(0)


class Killed(BaseException):
    """The driver is gone: nothing catches this."""


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture
def shop(crm):
    orders = [
        {
            "id": n, "activity_type_id": 33, "source_contact_id": 1 + n % 2, "payment_received": 1, "order_exported": 0,
            "order_type": kind, "activity_date_time": AS_OF, "multi_purpose": f'a "{n}"; b',
        }
        for n, kind in enumerate(["1", "2", None, "1", "03", "03", "1"], start=1)
    ]
    return crm(
        contact=[{"id": 1, "first_name": "A"}, {"id": 2, "first_name": "B"}],
        activity=[{"id": 10}],
        campaign=[{"id": 35, "external_identifier": "Web_Shop"}],
        option_group=OPTION_GROUPS,
        option_value=[
            option("activity_type", "33", "Webshop Order"),
            option("activity_type", "34", "Action"),
            option("activity_status", "2", "Completed"),
        ],
        webshop_order=orders,
    )


def _exported(folder):
    """The order ids in the files of all routes that are marked as complete, over all runs."""
    found = []
    for mark in glob.glob(f"{folder}/run*/file-*/_COMPLETE"):
        for part in glob.glob(f"{os.path.dirname(mark)}/**/part-*", recursive=True):
            with open(part, newline="", encoding="utf-8") as lines:
                found += [int(row["id"]) for row in csv.DictReader(lines, delimiter=";")]
    return sorted(found)


def _run(spark, shop, folder, run_id, **more):
    return runs.run_orders(shop, routes(spark, SETTING), folder, run_id, AS_OF, f"{folder}-ledger", **more).collect()


def _in_ledger(spark, folder):
    return values(ledger.read_ledger(spark, f"{folder}-ledger"), "id")


@pytest.fixture(autouse=True)
def id_in_file(monkeypatch):
    monkeypatch.setattr(runs.exports, "ORDER_KEYS", ["id", *[key for key in ORDER_KEYS if key != "id"]])


def _kill(monkeypatch, module, name, when=lambda *a: True):
    real = getattr(module, name)

    def dying(*args, **more):
        if when(*args):
            raise Killed
        return real(*args, **more)

    monkeypatch.setattr(module, name, dying)


def test_killed_between_files_and_ledger(spark, shop, folder, monkeypatch):
    _kill(monkeypatch, runs, "settle")
    with pytest.raises(Killed):
        _run(spark, shop, folder, "run1")
    monkeypatch.undo()
    assert _in_ledger(spark, folder) == [] and _exported(folder)
    # Another run takes none of its orders, whether it settles the dead one or still waits for it.
    monkeypatch.setattr(runs.exports, "ORDER_KEYS", ["id"])
    assert _run(spark, shop, folder, "run2")[0]["count"] == 0
    assert _run(spark, shop, folder, "run3", patience=NOW)[0]["count"] == 0
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]


def test_killed_between_two_files(spark, shop, folder, monkeypatch):
    _kill(monkeypatch, runs, "write_routed", lambda df, keys, path: path.endswith("file-03"))
    with pytest.raises(Killed):
        _run(spark, shop, folder, "run1")
    monkeypatch.undo()
    monkeypatch.setattr(runs.exports, "ORDER_KEYS", ["id"])
    done = _exported(folder)
    assert 0 < len(done) < 7
    # What a writer leaves behind without a mark counts as nothing and goes.
    os.makedirs(f"{folder}/run1/file-03")
    open(f"{folder}/run1/file-03/part-0", "w").write("half a fi")
    second = _run(spark, shop, folder, "run2", patience=NOW)
    assert sum(r["count"] for r in second) == 7 - len(done)
    assert not os.path.exists(f"{folder}/run1/file-03/part-0")
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]


def test_a_dead_run_goes_on_under_its_id(spark, shop, folder, monkeypatch):
    _kill(monkeypatch, runs, "write_routed", lambda df, keys, path: path.endswith("file-03"))
    with pytest.raises(Killed):
        _run(spark, shop, folder, "run1", create_activity=True)
    monkeypatch.undo()
    monkeypatch.setattr(runs.exports, "ORDER_KEYS", ["id"])
    again = _run(spark, shop, folder, "run1", create_activity=True)
    assert {r.route_key: (r["count"], r.is_error) for r in again} == {"1": (3, False), "default": (2, False), "03": (2, False)}
    third = _run(spark, shop, folder, "run1", create_activity=True)
    assert sorted(map(tuple, third)) == sorted(map(tuple, again))
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]
    assert runs.earlier_records(spark, folder, "activity_contact").count() == 2
    assert runs.earlier_records(spark, folder).count() == 1


def test_killed_while_the_ledger_is_written(spark, shop, folder, monkeypatch):
    _kill(monkeypatch, ledger.storage, "mark_complete", lambda s, path: "-ledger/run_id=" in path)
    with pytest.raises(Killed):
        _run(spark, shop, folder, "run1")
    monkeypatch.undo()
    monkeypatch.setattr(runs.exports, "ORDER_KEYS", ["id"])
    assert _run(spark, shop, folder, "run2", patience=NOW)[0]["count"] == 0
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]


def test_two_order_runs_at_once_share_no_order(spark, shop, folder, monkeypatch):
    """The second run begins and ends after the first one has chosen its orders and before it enters them."""
    chosen = []
    real = runs.begin

    def interleaved(spark_, book, run_id, as_of, path, keys, select):
        def late(taken):
            picked = select(taken)
            if run_id == "run1" and not chosen:
                chosen.append(picked)
                _run(spark, shop, folder, "run2")
            return picked

        return real(spark_, book, run_id, as_of, path, keys, late)

    monkeypatch.setattr(runs, "begin", interleaved)
    first = _run(spark, shop, folder, "run1")
    assert chosen and first[0].message == "No valid activities found for export"
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]


def test_a_run_taken_for_dead_says_so(spark, shop, folder, monkeypatch):
    """While the first run writes, another one settles it and exports the rest: nothing twice."""
    real = runs.write_routed

    def slow(df, keys, path):
        if path.endswith("run1/file-03"):
            _run(spark, shop, folder, "run2", patience=NOW)
        return real(df, keys, path)

    monkeypatch.setattr(runs, "write_routed", slow)
    first = {r.route_key: (r.is_error, r.message) for r in _run(spark, shop, folder, "run1")}
    assert first["03"] == (True, runs.SETTLED_ELSEWHERE)
    assert _exported(folder) == _in_ledger(spark, folder) == [1, 2, 3, 4, 5, 6, 7]


def test_exact_files_of_three_routes(spark, crm, folder, monkeypatch):
    """The parts of each route, one after the other, are the bytes of a single writer."""
    kinds = ["1", "03", None, "1", "1"]
    t = crm(
        contact=[{"id": 1, "first_name": "A"}],
        option_group=OPTION_GROUPS,
        option_value=[option("activity_type", "33", "Webshop Order")],
        webshop_order=[
            {
                "id": 5000 - n, "activity_type_id": 33, "source_contact_id": 1, "payment_received": 1, "order_exported": 0,
                "order_type": kinds[n % 5], "activity_date_time": AS_OF, "multi_purpose": ["x y", 'a "b"', "l1\nl2", None][n % 4],
            }
            for n in range(1000)
        ],
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = _run(spark, t, folder, "run1", exact=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = runs.exports.ORDER_KEYS
    staged = spark.read.schema("route_key string").parquet(f"{folder}/run1/audience")
    whole = runs._staged_orders(spark, f"{folder}/run1/audience").withColumn("line", csv_line([F.col(key) for key in keys], ";"))
    assert {r.route_key: r["count"] for r in report} == {"1": 600, "03": 200, "default": 200}
    for row in report:
        parts = sorted(glob.glob(f"{row.folder}/part-*"))
        assert len(parts) >= 3
        lines = [r.line for r in whole.filter(F.col("route_key") == row.route_key).orderBy("id").collect()]
        expected = "".join(f"{line}\n" for line in [";".join(keys), *lines])
        assert b"".join(open(part, "rb").read() for part in parts) == expected.encode()
        back = list(csv.DictReader(io.StringIO(expected, newline=""), delimiter=";"))
        assert [int(r["id"]) for r in back] == sorted(int(r["id"]) for r in back) and len(back) == row["count"]
    assert staged.count() == 1000


def test_exact_file_without_rows(spark, folder):
    assert not files.write_exact(local_rows(spark, [], "a string"), ["a"], folder, ["a"])
    assert not os.path.exists(folder)


# Claims and ids.


def test_of_many_claims_one_succeeds(spark, folder):
    with ThreadPoolExecutor(16) as pool:
        for number in range(20):
            path = f"{folder}/claims/{number}"
            notes = [f"owner {n} " * 50 for n in range(16)]
            won = list(pool.map(lambda note, path=path: storage.claim(spark, path, note), notes))
            assert won.count(True) == 1
            assert storage.note(spark, path) == notes[won.index(True)]
    assert [path.rsplit("/", 1)[1] for path in storage.find(spark, f"{folder}/claims/*")] == sorted(map(str, range(20)))


def test_runs_at_once_hold_different_ids(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        firsts = list(pool.map(lambda n: ids.reserve(spark, folder, f"run{n}", 2500, 5000), range(8)))
    held = [first for blocks in firsts for first in blocks]
    assert len(held) == len(set(held)) == 8 * 3
    assert min(held) > 5000 and all(first % ids.BLOCK == 0 for first in held)
    assert ids.reserve(spark, folder, "run3", 2500, 10**9) == firsts[3]
    more = ids.reserve(spark, folder, "run3", 4000, 10**9)
    assert more[:3] == firsts[3] and more[3] > 10**9
    assert ids.reserve(spark, folder, "later", 1, 0)[0] > max(more)


def test_rows_are_numbered_without_gaps(spark, folder):
    rows = spark.range(5000, numPartitions=7).filter("id % 3 = 0 or id > 4000").select("id")
    found = ids.numbered(rows, folder)
    assert values(found, "number") == list(range(rows.count()))
    firsts = [10240, 3072, 99328]
    made = [r.made for r in found.withColumn("made", ids.id_of(F.col("number"), firsts)).collect()]
    assert len(set(made)) == len(made) and set(made) <= {first + n for first in firsts for n in range(ids.BLOCK)}
    assert values(ids.numbered(rows.filter("id < 0"), f"{folder}-none"), "number") == []


# Follow-up records.


def test_appended_rows_are_new_and_repeatable(spark, folder):
    base = local_rows(spark, [(1, 1, "old")], "a bigint, b bigint, c string")
    rows = local_rows(spark, [(1, 1, "x"), (1, 2, "x"), (1, 2, "y"), (2, 1, "x"), (None, 1, "n")], "a bigint, b bigint, c string")
    for run_id in ("r", "r", "s"):
        append.append_new(rows, folder, ["a", "b"], run_id, base)
    found = append.read_parts(spark, folder, rows.schema)
    assert sorted((r.a, r.b) for r in found.filter("a is not null").collect()) == [(1, 2), (2, 1)]
    # An interrupted part is not seen, and replaced by the next try.
    os.remove(f"{folder}/run_id=r/_COMPLETE")
    assert append.read_parts(spark, folder, rows.schema).filter("a is not null").isEmpty()
    append.append_new(rows, folder, ["a", "b"], "r", base)
    assert append.read_parts(spark, folder, rows.schema).filter("a is not null").count() == 2


def test_a_repeated_file_run_adds_nothing(spark, crm, folder):
    t = crm(contact=[{"id": 1}, {"id": 2}], activity=[{"id": 4}], activity_contact=[{"activity_id": 4, "contact_id": 1, "record_type_id": 3}])
    rows = local_rows(spark, [(1, "a"), (2, "b")], "contact_id bigint, Email string")
    table = routes(spark, SETTING)

    def run():
        return runs.run_file_export(t, rows, ["Email"], table, folder, "r", AS_OF, create_activity=True, subject="s").collect()

    first = run()
    parts = sorted(glob.glob(f"{folder}/r/file/part-*"))
    links = runs.earlier_records(spark, folder, "activity_contact").collect()
    assert run() == first and sorted(glob.glob(f"{folder}/r/file/part-*")) == parts
    assert sorted(runs.earlier_records(spark, folder, "activity_contact").collect()) == sorted(links) and len(links) == 2


def test_records_are_seen_together_or_not_at_all(spark, folder, monkeypatch):
    t = DerivedTables(spark, "/root/testdata/sf0.01")
    real = runs.append_new

    def failing(rows, target, *more):
        if target.endswith("/activity"):
            rows = rows.filter(F.raise_error(F.lit("disk full")).isNull())
        return real(rows, target, *more)

    monkeypatch.setattr(runs, "append_new", failing)
    report = runs.run_calls(t, folder, "r", AS_OF).first()
    assert report["count"] > 0 and "disk full" in report.follow_up_error
    assert glob.glob(f"{folder}/follow_up/activity_contact/run_id=r/part-*")
    assert all(runs.earlier_records(spark, folder, name).isEmpty() for name in ("activity", "activity_contact"))
    monkeypatch.undo()
    again = runs.run_calls(t, folder, "r", AS_OF).first()
    assert again.follow_up_error is None
    calls, links = (runs.earlier_records(spark, folder, name) for name in ("activity", "activity_contact"))
    assert calls.count() == again["count"] and links.count() == 5 * again["count"]
    assert set(values(links, "activity_id")) == set(values(calls, "id"))


def test_two_call_runs_at_once_share_no_id(spark, folder, monkeypatch):
    t = DerivedTables(spark, "/root/testdata/sf0.01")
    real, inner = runs.number_calls, []

    def interleaved(audience, t, book, run_id, path, *earlier):
        if run_id == "a":
            # The other run begins with the same tables, before either has written a record.
            inner.append(real(audience, t, book, "b", f"{path}-b", *earlier))
        return real(audience, t, book, run_id, path, *earlier)

    monkeypatch.setattr(runs, "number_calls", interleaved)
    runs.run_calls(t, folder, "a", AS_OF)
    mine = set(values(runs.earlier_records(spark, folder), "id"))
    assert mine and not mine & set(values(inner[0], "activity_id"))


def test_staged_rows_are_kept(spark, folder):
    staged = place.stage(spark.range(3), folder)
    assert place.stage(spark.range(9), folder).count() == staged.count() == 3
    os.remove(f"{folder}/_COMPLETE")
    assert place.stage(spark.range(9), folder).count() == 9


def test_a_call_for_nobody(crm, spark, folder):
    t = crm(activity=[{"id": 1}], option_group=OPTION_GROUPS)
    nobody = local_rows(spark, [], "contact_id bigint")
    assert follow_up.number_calls(nobody, t, f"{folder}/ids", "r", folder).isEmpty()
    assert not glob.glob(f"{folder}/ids/blocks/*")
