"""Files, follow-up records, ledger, summary and whole runs."""

from __future__ import annotations

import csv
import glob
import random
from collections import Counter
from datetime import datetime
from types import SimpleNamespace

import pytest
from crm_rows import OPTION_GROUPS, option, values
from pyspark.sql import functions as F

from muster.functions.text import csv_line
from muster.plans import exports
from muster.plans.exports import EMAIL_KEYS, MAILING_KEYS, ORDER_KEYS, POST_KEYS
from muster.sinks import files, follow_up, ledger, place, runs
from muster.sinks.summary import summary
from muster.sources.derived import DerivedTables
from muster.sources.local import local_rows
from muster.sources.tables import LazyTables, load_tables, routes

AS_OF = datetime(2001, 7, 15, 12)
SETTING = (
    '{"default":{"file":"d","remote":"x/"},"1":{"file":"one","remote":"y/"},"3":{"file":"three","remote":"z/"}}'
)

NASTY = ["plain", "a;b", 'say "hi"', "back\\slash", "two\nlines", " lead", "trail ", "in ner", "tab\there", "", None]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "out")


def _text(path: str) -> str:
    return "".join(open(part, newline="").read() for part in sorted(glob.glob(f"{path}/part-*")))


def test_csv_reads_back(spark, folder):
    df = local_rows(spark, [(n, text) for n, text in enumerate(NASTY)], "id int, text string").coalesce(1)
    assert files.write_csv(df, ["id", "text"], folder)
    back = files.read_csv(spark, folder, df.schema)
    assert {r.id: r.text for r in back.collect()} == {n: text or None for n, text in enumerate(NASTY)}


def test_csv_text(spark, folder):
    rows = [("a", None, ""), ('q"q', "x;y", " pad ")]
    df = local_rows(spark, rows, "a string, b string, c string").coalesce(1)
    files.write_csv(df, ["c", "a", "b"], folder)
    assert _text(folder) == 'c;a;b\n;a;\n pad ;"q""q";"x;y"\n'


def test_any_text_survives_the_file(spark, folder):
    """Random texts of troublesome characters, read by another CSV reader."""
    source = random.Random(7)
    alphabet = list("ab ;,\"'\\\n\t|#") + ["ä", "–", "😀", "\r\n"]
    texts = ["".join(source.choices(alphabet, k=source.randint(1, 12))) for _ in range(3000)]
    df = local_rows(spark, list(enumerate(texts)), "id int, text string")
    files.write_csv(df.repartition(3), ["id", "text"], folder)
    found = {}
    for part in glob.glob(f"{folder}/part-*"):
        with open(part, newline="", encoding="utf-8") as lines:
            rows = list(csv.reader(lines, delimiter=";", quotechar='"', doublequote=True))
        assert rows[0] == ["id", "text"]
        found |= {int(number): text for number, text in rows[1:]}
    assert found == dict(enumerate(texts))


def test_no_rows_no_file(spark, folder):
    empty = local_rows(spark, [], "a string, route_key string")
    assert not files.write_csv(empty, ["a"], folder)
    assert not files.write_csv_lines(empty, ["a"], folder)
    assert not files.write_routed(empty, ["a"], folder)
    assert not glob.glob(folder)


@pytest.mark.parametrize(
    ("text", "field"),
    [
        ("plain", "plain"),
        ("a;b", '"a;b"'),
        ('say "hi"', '"say ""hi"""'),
        ("back\\slash", '"back\\slash"'),
        ('a\\"b"c', '"a\\"b""c"'),
        ('\\""', '"\\""""'),
        ("two\nlines", '"two\nlines"'),
        ("cr\rx", '"cr\rx"'),
        (" lead", '" lead"'),
        ("in ner", '"in ner"'),
        ("tab\there", '"tab\there"'),
        ("a,b'c", "a,b'c"),
        ("", ""),
        (None, ""),
    ],
)
def test_exact_field(spark, text, field):
    df = local_rows(spark, [(text, 1)], "a string, b int")
    assert df.select(csv_line([F.col("a"), F.col("b")])).first()[0] == f"{field};1"


def test_exact_file(spark, folder):
    df = local_rows(spark, [("x y", 1)], "`first name` string, b int")
    assert files.write_csv_lines(df, ["first name", "b"], folder)
    assert _text(f"{folder}/header") + _text(f"{folder}/lines") == '"first name";b\n"x y";1\n'


def test_routed_files_hold_every_row(spark, folder):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "1").otherwise("default").alias("route_key"))
    files.write_routed(df, ["id"], folder, max_rows_per_file=100)
    assert len(glob.glob(f"{folder}/route_key=default/*.csv")) >= 7
    back = files.read_csv(spark, folder, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_mass_activity(crm, spark):
    t = crm(
        contact=[{"id": 1}, {"id": 2}],
        activity=[{"id": 41}],
        campaign=[{"id": 7, "external_identifier": "X"}],
        option_group=OPTION_GROUPS,
        option_value=[option("activity_type", "34", "Action"), option("activity_status", "2", "Completed")],
    )
    exported = local_rows(spark, [(1,), (1,), (2,), (9,)], "contact_id bigint")
    record, links = follow_up.mass_activity(exported, t, AS_OF, 42, "s", "X")
    assert [tuple(r) for r in record.collect()] == [(42, 34, 7, 2, AS_OF, None, "s")]
    assert record.drop("subject").schema.simpleString() == t["activity"].schema.simpleString()
    assert links.schema.simpleString() == t["activity_contact"].schema.simpleString()
    assert sorted(tuple(r) for r in links.collect()) == [(42, 1, 3), (42, 2, 3)]
    nobody = exported.filter("contact_id < 0")
    record, links = follow_up.mass_activity(nobody, t, AS_OF, 42, "s")
    assert record.isEmpty() and links.isEmpty()


def test_call_tasks(crm, spark, folder):
    t = crm(
        activity=[{"id": 100}],
        option_group=OPTION_GROUPS,
        option_value=[option("activity_type", "35", "Outgoing Call"), option("activity_status", "1", "Scheduled")],
    )
    exported = local_rows(spark, [(5,), (6,), (6,)], "contact_id bigint")
    numbered = follow_up.number_calls(exported, t, f"{folder}/ids", "r", folder)
    calls, links = follow_up.call_tasks(numbered, t, AS_OF)
    numbers = {r.contact_id: r.activity_id for r in numbered.collect()}
    assert len(set(numbers.values())) == 2 and min(numbers.values()) > 100
    assert {tuple(r) for r in calls.collect()} == {
        (number, 35, 43, 1, AS_OF, None, "Service Call") for number in numbers.values()
    }
    found = {tuple(r)[1:] for r in links.filter(F.col("activity_id") == numbers[5]).collect()}
    assert found == {(5, 3), (94, 1), (77, 1), (105, 1), (16, 2)}


def test_ledger_leaves_failed_routes_pending(spark):
    orders = local_rows(spark, [(1, "default"), (2, "1"), (3, "3")], "id bigint, route_key string")
    status = local_rows(spark, [("default", False), ("1", True)], "route_key string, is_error boolean")
    marked = ledger.mark_exported(orders, status, AS_OF)
    assert [tuple(r) for r in marked.collect()] == [(1, 1, AS_OF, 2)]
    assert values(ledger.not_in_ledger(orders, marked), "id") == [2, 3]


def test_summary_of_empty_and_failed_routes(spark):
    rows = local_rows(spark, [("1",), ("1",), ("default",)], "route_key string")
    status = local_rows(
        spark, [("1", "disk full", 7), ("default", None, 0)], "route_key string, message string, error_code int"
    )
    table, where = routes(spark, SETTING), F.concat(F.lit("x/"), F.col("route_key"))
    found = {r.route_key: tuple(r)[1:] for r in summary(rows, table, AS_OF, status, folder=where).collect()}
    assert found == {
        "1": (2, "one_20010715120000.csv", None, True, "disk full", 7, None),
        "default": (1, "d_20010715120000.csv", "x/default", False, None, 0, None),
        "3": (0, "three_20010715120000.csv", None, True, "No data available for upload", 1, None),
    }
    assert values(summary(rows, table, AS_OF, report_empty=False), "route_key") == ["1", "default"]


def _shop(crm):
    orders = [
        {
            "id": n, "activity_type_id": 33, "source_contact_id": 1 + n % 2, "payment_received": 1, "order_exported": 0,
            "order_type": kind, "activity_date_time": AS_OF,
        }
        for n, kind in enumerate(["1", "2", None, "1"], start=1)
    ]
    return crm(
        contact=[{"id": 1, "first_name": "A"}, {"id": 2, "first_name": "B"}],
        activity=[{"id": 10}],
        campaign=[{"id": 35, "external_identifier": "Web_Shop"}],
        option_group=OPTION_GROUPS,
        option_value=[option("activity_type", "33", "Webshop Order")],
        webshop_order=orders,
    )


def test_order_run_and_next_run(crm, spark, folder):
    t, table, book = _shop(crm), routes(spark, SETTING), f"{folder}/ledger"
    first = runs.run_orders(t, table, folder, "run1", AS_OF, book, create_activity=True, subject="sent")
    assert {r.route_key: (r["count"], r.is_error) for r in first.collect()} == {"1": (2, False), "default": (2, False)}
    back = files.read_csv(spark, f"{folder}/run1/file-1", spark.read.parquet(f"{folder}/run1/audience").schema)
    assert back.count() == 2
    head = _text(f"{folder}/run1/file-1/route_key=1").splitlines()[0]
    assert head == ";".join(ORDER_KEYS)
    assert values(spark.read.parquet(book), "id") == [1, 2, 3, 4]
    record = spark.read.parquet(f"{folder}/follow_up/activity").first()
    assert (record.id, record.subject, record.campaign_id) == (1024, "sent", 35)
    assert values(runs.earlier_records(spark, folder, "activity_contact"), "contact_id") == [1, 2]
    second = runs.run_orders(t, table, folder, "run2", AS_OF, book)
    assert [(r.route_key, r["count"], r.is_error, r.message) for r in second.collect()] == [
        ("default", 0, True, "No valid activities found for export")
    ]
    assert not glob.glob(f"{folder}/run2/file-*")


def test_failing_follow_up_is_reported_and_exports_nothing_again(crm, spark, folder):
    t, table, book = _shop(crm), routes(spark, SETTING), f"{folder}/ledger"
    # Two campaigns of one identifier: the lookup of the record's campaign fails.
    t["campaign"] = t["campaign"].unionByName(t["campaign"].withColumn("id", F.col("id") + 1))
    first = runs.run_orders(t, table, folder, "run1", AS_OF, book, create_activity=True).collect()
    assert sum(r["count"] for r in first) == 4
    assert all(not r.is_error and r.follow_up_error for r in first)
    assert values(spark.read.parquet(book), "id") == [1, 2, 3, 4]
    second = runs.run_orders(t, table, folder, "run2", AS_OF, book, create_activity=True).first()
    assert second["count"] == 0


def test_next_run_sees_what_the_last_one_did(spark, folder):
    """Appended records of post and call runs keep everyone from a second package and a second call."""
    derived = DerivedTables(spark, "/root/testdata/sf0.01")
    table = routes(spark, SETTING)
    plan = follow_up.CallPlan(campaign_id=11)
    post = runs.run_welcome_post(derived, table, folder, "post1", AS_OF, create_activity=True).first()
    mail = runs.run_welcome_email(derived, table, folder, "mail1", AS_OF, create_activity=True, floor="1995-01-01").first()
    calls = runs.run_calls(derived, folder, "call1", AS_OF, plan).first()
    assert post["count"] > 0 and mail["count"] > 0 and calls["count"] > 0 and not calls.follow_up_error
    records = {name: runs.earlier_records(spark, folder, name) for name in ("activity", "activity_contact")}
    numbers = values(records["activity"], "id")
    assert len(numbers) == len(set(numbers)) == 2 + calls["count"]
    t = LazyTables(lambda name: derived[name].unionByName(records[name]) if name in records else derived[name])
    again = runs.run_welcome_post(t, table, folder, "post2", AS_OF).first()
    assert again.message == "No data available for upload"
    assert runs.run_calls(t, folder, "call2", AS_OF, plan).first()["count"] == 0


def test_order_run_with_a_failing_route(crm, spark, folder, monkeypatch):
    t, table, book = _shop(crm), routes(spark, SETTING), f"{folder}/ledger"
    write = runs.write_routed

    def failing(df, keys, path):
        # A file in the way makes Spark's own write fail.
        if path.endswith("file-1"):
            df.limit(1).select(F.lit("x")).write.text(path)
        return write(df, keys, path)

    monkeypatch.setattr(runs, "write_routed", failing)
    report = runs.run_orders(t, table, folder, "run1", AS_OF, book, create_activity=True, subject="sent")
    found = {r.route_key: (r["count"], r.is_error, r.error_code) for r in report.collect()}
    assert found == {"1": (2, True, 2), "default": (2, False, 0)}
    assert values(spark.read.parquet(book), "id") == [2, 3]
    monkeypatch.undo()
    again = runs.run_orders(t, table, folder, "run2", AS_OF, book)
    assert {r.route_key: r["count"] for r in again.collect()} == {"1": 2}
    assert values(spark.read.parquet(book), "id") == [1, 2, 3, 4]


def test_file_run(crm, spark, folder):
    t = crm(contact=[{"id": 1}], activity=[{"id": 4}])
    rows = local_rows(spark, [(1, "a b")], "contact_id bigint, Email string")
    report = runs.run_file_export(
        t, rows, ["Email", "contact_id"], routes(spark, SETTING), folder, "r1", AS_OF, create_activity=True, subject="s"
    )
    assert (report.first()["count"], report.first().is_error) == (1, False)
    assert _text(f"{folder}/r1/file") == "Email;contact_id\na b;1\n"
    assert runs.earlier_records(spark, folder, "activity_contact").count() == 1
    assert report.first().folder == f"{folder}/r1/file"
    nothing = rows.filter("contact_id = 2")
    report = runs.run_file_export(
        t, nothing, ["Email", "contact_id"], routes(spark, SETTING), folder, "r2", AS_OF, create_activity=True
    )
    assert tuple(report.first())[1:] == (0, "d_20010715120000.csv", None, True, "No data available for upload", 1, None)
    keys = ["Email", "contact_id"]
    report = runs.run_file_export(t, rows, keys, routes(spark, SETTING), folder, "r3", AS_OF, exact=True)
    assert not report.first().is_error
    assert _text(f"{folder}/r3/file/header") + _text(f"{folder}/r3/file/lines") == 'Email;contact_id\n"a b";1\n'
    assert not glob.glob(f"{folder}/r2/file") and not glob.glob(f"{folder}/follow_up/*/run_id=r2")


def test_file_run_with_a_failing_write(crm, spark, folder):
    t = crm(contact=[{"id": 1}], activity=[{"id": 4}])
    rows = local_rows(spark, [(1, "a b")], "contact_id bigint, Email string")
    rows.select("Email").write.text(f"{folder}/r1/file")
    report = runs.run_file_export(
        t, rows, ["Email", "contact_id"], routes(spark, SETTING), folder, "r1", AS_OF, create_activity=True
    ).first()
    assert (report["count"], report.is_error, report.error_code) == (1, True, 2)
    assert "file" in report.message.lower()
    assert not glob.glob(f"{folder}/follow_up")


@pytest.mark.parametrize(
    ("run", "keys", "count"),
    [
        (lambda *a: runs.run_mailing(*a, create_activity=True, subject="sent"), MAILING_KEYS, 57),
        (lambda *a: runs.run_welcome_post(*a, create_activity=True), POST_KEYS, 5),
        (lambda *a: runs.run_welcome_email(*a, create_activity=True, floor="1995-01-01"), EMAIL_KEYS, 1),
    ],
)
def test_whole_runs(spark, folder, run, keys, count):
    t = DerivedTables(spark, "/root/testdata/sf0.001")
    report = run(t, routes(spark, SETTING), folder, "r", AS_OF).first()
    assert (report["count"], report.is_error) == (count, False)
    staged = spark.read.parquet(f"{folder}/r/audience")
    back = files.read_csv(spark, f"{folder}/r/file", staged.select(*keys).schema)
    assert back.exceptAll(staged.select(*keys)).isEmpty() and back.count() == count
    links = runs.earlier_records(spark, folder, "activity_contact")
    assert values(links, "contact_id") == values(staged, "contact_id")


def test_call_run(spark, folder):
    t = DerivedTables(spark, "/root/testdata/sf0.01")
    report = runs.run_calls(t, folder, "r", AS_OF).first()
    calls = runs.earlier_records(spark, folder)
    assert calls.count() == exports.export_welcome_call(t, AS_OF).count() == report["count"] > 3
    assert (report.is_error, report.follow_up_error) == (False, None)
    links = runs.earlier_records(spark, folder, "activity_contact")
    assert links.count() == 5 * calls.count()
    assert links.join(calls.select(F.col("id").alias("activity_id")), "activity_id", "left_anti").isEmpty()


def test_tables_are_checked_against_the_contract(crm, spark, folder):
    t = crm(country=[{"id": 1, "iso_code": "AT"}])
    t["country"].write.parquet(f"{folder}/country.parquet")
    t["country"].drop("name").write.parquet(f"{folder}/tag.parquet")
    stored = load_tables(spark, folder)
    assert stored["country"].schema == t["country"].schema
    assert stored["country"].collect() == t["country"].collect()
    with pytest.raises(ValueError, match="missing columns: name"):
        stored["tag"]


def test_collation_is_an_option(spark, folder):
    derived = DerivedTables(spark, "/root/testdata/sf0.001")
    plain = LazyTables(lambda name: derived[name])
    lower = LazyTables(
        lambda name: derived[name].replace("IMB-1", "user-1", "external_identifier").replace("Individual", "INDIVIDUAL")
        if name == "contact"
        else derived[name],
        "UTF8_LCASE",
    )
    usual = exports.export_mailing(plain)
    found = exports.export_mailing(lower)
    assert found.schema == usual.schema
    assert set(values(usual, "contact_id")) - set(values(found, "contact_id")) == {1}
    assert Counter(exports.export_welcome_post(lower, AS_OF).collect()) == Counter(
        exports.export_welcome_post(plain, AS_OF).collect()
    )
    table = routes(spark, SETTING)
    assert Counter(exports.export_orders(lower, table).collect()) == Counter(exports.export_orders(plain, table).collect())
    report = runs.run_orders(lower, table, folder, "r", AS_OF, f"{folder}/ledger")
    assert {r.is_error for r in report.collect()} == {False}


def test_run_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = place.run_folder(spark), place.run_folder(spark)
    assert one != two and one.startswith(f"{shared}/") and two.startswith(f"{shared}/")


def test_run_folder_without_a_shared_one():
    warehouse = SimpleNamespace(conf={"spark.sql.warehouse.dir": "s3a://warehouse/"})
    assert place.run_folder(warehouse).startswith("s3a://warehouse/muster-")
    here = {"spark.sql.warehouse.dir": "file:/home/driver/spark-warehouse"}
    assert place.run_folder(SimpleNamespace(conf=here | {"spark.master": "local[4]"})).startswith("file:/home")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            place.run_folder(SimpleNamespace(conf=here | {"spark.master": master}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        place.run_folder(SimpleNamespace(conf={}))
