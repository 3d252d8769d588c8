"""Whole runs: stage the audience, write files, then follow-up records, ledger and summary.

Everything of one run lies in ``<out>/<run_id>``. The staged audience is written once and read by all later
steps, so a lost executor cannot make file and links disagree. Each step leaves a mark when it is complete: a run that died
is finished by running it again under its run id. An order run enters its orders into the ledger's log before it writes a
file (see ``ledger``). Follow-up records come last, and their failure is reported, not raised. They lie below
``<out>/follow_up``, an activity and its links visible together or not at all; their ids are reserved for the run and lie
above those of the activity table. They fit both tables and are appended to them by whoever owns these.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.operators.lookups import Tables
from muster.plans import exports
from muster.schemas import SCHEMAS
from muster.sinks import ids, storage
from muster.sinks.append import append_new
from muster.sinks.files import write_csv, write_csv_lines, write_exact, write_routed
from muster.sinks.follow_up import CallPlan, call_tasks, mass_activity, number_calls
from muster.sinks.ledger import PATIENCE, begin, find_intent, not_in_ledger, recover, settle
from muster.sinks.place import stage
from muster.sinks.summary import nothing_to_export, records_only, summary
from muster.sources.local import local_rows
from muster.sources.tables import DEFAULT_ROUTE, pending_orders

# Campaigns and subjects of the follow-up records.
POST_CAMPAIGN, POST_SUBJECT = "AKTION-7767", "Welcome Package: Postal"
EMAIL_CAMPAIGN, EMAIL_SUBJECT = "AKTION-7769", "Welcome Package: Email"
ORDER_CAMPAIGN, ORDER_SUBJECT = "Web_Shop", "Webshop Versand"
WRITE_FAILED = 2
#: What tells a follow-up link from others.
LINK = ["activity_id", "contact_id", "record_type_id"]
SETTLED_ELSEWHERE = "another run has settled this one; the file was removed"


def _attempt(route: str, write: Callable[[], object]) -> tuple[str, bool, str | None, int]:
    """Run one write; a failure becomes the route's status and stops no other route."""
    try:
        write()
    except (Py4JJavaError, PySparkException) as error:
        return route, True, str(error).splitlines()[0], WRITE_FAILED
    return route, False, None, 0


def _status(spark: SparkSession, outcomes: Sequence[tuple]) -> DataFrame:
    return local_rows(spark, outcomes, "route_key string, is_error boolean, message string, error_code int")


def earlier_records(spark: SparkSession, out: str, table: str = "activity") -> DataFrame:
    """The follow-up records (``activity``) or links (``activity_contact``) of all runs below ``out`` that have both."""
    runs = [path.rsplit("/", 1)[1] for path in storage.find(spark, f"{out}/follow_up/runs/*")]
    if not runs:
        return local_rows(spark, [], SCHEMAS[table])
    return spark.read.schema(SCHEMAS[table]).parquet(*[f"{out}/follow_up/{table}/run_id={run}" for run in runs])


def _record(t: Tables, records: DataFrame, links: DataFrame, out: str, run_id: str, lowest: int) -> None:
    """Append a run's records and links and make both visible by one mark. ``lowest`` is the first of the run's ids."""
    store, spark = f"{out}/follow_up", records.sparkSession
    append_new(links, f"{store}/activity_contact", LINK, run_id, t["activity_contact"].filter(F.col("activity_id") >= lowest))
    append_new(records, f"{store}/activity", ["id"], run_id, t["activity"].filter(F.col("id") >= lowest))
    storage.claim(spark, f"{store}/runs/{run_id}")


def _recorded(spark: SparkSession, out: str, run_id: str) -> bool:
    return storage.exists(spark, f"{out}/follow_up/runs/{run_id}")


def _follow_up(
    t: Tables, exported: DataFrame, out: str, run_id: str, as_of: datetime, subject: str, campaign: str | None
) -> str | None:
    """Write the records of a run, once however often it is repeated; a failure becomes a message."""
    spark = exported.sparkSession

    def write() -> None:
        if not _recorded(spark, out, run_id):
            highest = ids.highest_id(t["activity"], earlier_records(spark, out))
            number = ids.reserve(spark, f"{out}/ids/activity", run_id, 1, highest)[0]
            records, links = mass_activity(exported, t, as_of, number, subject, campaign)
            _record(t, records, links, out, run_id, number)

    return _attempt(DEFAULT_ROUTE, write)[2]


def _write_once(spark: SparkSession, path: str, resumed: bool, write: Callable[[str], bool]) -> None:
    """Write a folder and mark it as complete, unless it is; a resumed run removes what it left half done."""
    if not storage.complete(spark, path):
        if resumed:
            storage.delete(spark, path)
        if write(path):
            storage.mark_complete(spark, path)


def run_file_export(
    t: Tables,
    rows: DataFrame,
    keys: Sequence[str],
    routes: DataFrame,
    out: str,
    run_id: str,
    as_of: datetime,
    create_activity: bool = False,
    subject: str = "",
    campaign: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """One file on the default route; follow-up records only after it was written. Returns the summary.

    ``exact`` writes the byte-exact form: header and lines, which concatenated are one file with one header.
    """
    spark, folder = rows.sparkSession, f"{out}/{run_id}"
    resumed = storage.complete(spark, f"{folder}/audience")
    staged = stage(rows, f"{folder}/audience")
    write = write_csv_lines if exact else write_csv
    outcome = _attempt(
        DEFAULT_ROUTE,
        lambda: _write_once(spark, f"{folder}/file", resumed, lambda path: write(staged, keys, path)),
    )
    failed = None
    if create_activity and not outcome[1] and not staged.isEmpty():
        failed = _follow_up(t, staged, out, run_id, as_of, subject, campaign)
    default = routes.filter(F.col("route_key") == DEFAULT_ROUTE)
    status = _status(spark, [outcome])
    rows = staged.withColumn("route_key", F.lit(DEFAULT_ROUTE))
    return summary(rows, default, as_of, status, follow_up_error=failed, folder=F.lit(f"{folder}/file"))


def run_mailing(
    t: Tables,
    routes: DataFrame,
    out: str,
    run_id: str,
    as_of: datetime,
    create_activity: bool = False,
    subject: str = "",
    exact: bool = False,
) -> DataFrame:
    rows = exports.export_mailing(t)
    return run_file_export(
        t, rows, exports.MAILING_KEYS, routes, out, run_id, as_of, create_activity, subject, exact=exact
    )


def run_welcome_post(
    t: Tables,
    routes: DataFrame,
    out: str,
    run_id: str,
    as_of: datetime,
    create_activity: bool = False,
    subject: str = POST_SUBJECT,
    campaign: str = POST_CAMPAIGN,
    exact: bool = False,
) -> DataFrame:
    rows = exports.export_welcome_post(t, as_of, campaign)
    return run_file_export(
        t, rows, exports.POST_KEYS, routes, out, run_id, as_of, create_activity, subject, campaign, exact
    )


def run_welcome_email(
    t: Tables,
    routes: DataFrame,
    out: str,
    run_id: str,
    as_of: datetime,
    create_activity: bool = False,
    subject: str = EMAIL_SUBJECT,
    campaign: str = EMAIL_CAMPAIGN,
    floor: str | None = exports.EMAIL_FLOOR,
    exact: bool = False,
) -> DataFrame:
    rows = exports.export_welcome_email(t, as_of, floor)
    return run_file_export(
        t, rows, exports.EMAIL_KEYS, routes, out, run_id, as_of, create_activity, subject, campaign, exact
    )


def run_calls(t: Tables, out: str, run_id: str, as_of: datetime, plan: CallPlan = CallPlan()) -> DataFrame:
    """Planned calls and their links; no file. Returns the summary.

    Calls and links are those of ``earlier_records``: of all runs whose records are complete. A failure is reported, and no
    call is seen without its links or the other way round.
    """
    folder = f"{out}/{run_id}"
    audience = stage(exports.export_welcome_call(t, as_of), f"{folder}/audience")
    spark, people = audience.sparkSession, audience.select("contact_id").distinct().count()

    def write() -> None:
        if people and not _recorded(spark, out, run_id):
            earlier = earlier_records(spark, out)
            numbered = number_calls(audience, t, f"{out}/ids/activity", run_id, f"{folder}/calls", earlier)
            calls, links = call_tasks(numbered, t, as_of, plan)
            _record(t, calls, links, out, run_id, numbered.agg(F.min("activity_id")).first()[0])

    return records_only(spark, DEFAULT_ROUTE, people, _attempt(DEFAULT_ROUTE, write)[2])


def _staged_orders(spark: SparkSession, path: str) -> DataFrame:
    """The staged orders; the route in the folders' names is a text, also where it looks like a number."""
    fields = [T.StructField(f.name, T.StringType()) if f.name == "route_key" else f for f in spark.read.parquet(path).schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def run_orders(
    t: Tables,
    routes: DataFrame,
    out: str,
    run_id: str,
    as_of: datetime,
    ledger: str,
    create_activity: bool = False,
    subject: str = ORDER_SUBJECT,
    exact: bool = False,
    patience: timedelta = PATIENCE,
) -> DataFrame:
    """Routed order files, ledger, follow-up records; returns the summary of routes with rows.

    ``ledger`` is the folder of all runs' ledger rows. The run first settles runs that died (see ``ledger.recover`` for
    ``patience``), enters its orders into the log, writes the files and settles itself; that makes the orders count as
    exported. A run that is repeated after it died goes on with the orders that it holds. A run without orders writes nothing and
    says so. ``exact`` writes each route's lines by order number in the byte-exact form (``files.write_exact``).
    There is one follow-up activity per run (not one per order), linked to the contacts of the routes that were
    written (not to those of failed ones).
    """
    spark = routes.sparkSession
    folder = f"{out}/{run_id}"
    # The routes are a setting, a handful of keys; staged by route, each write reads its own rows only.
    keys = [row.route_key for row in routes.select("route_key").collect()]

    def select(taken: DataFrame) -> str | None:
        orders = not_in_ledger(pending_orders(t), taken)
        lines = exports.with_route(exports.order_lines(t, orders), routes)
        storage.delete(spark, f"{folder}/audience")
        return None if stage(lines, f"{folder}/audience", by="route_key").isEmpty() else f"{folder}/audience"

    intent = find_intent(spark, ledger, run_id)
    resumed = intent is not None
    if intent is None:
        recover(spark, ledger, patience)
        intent = begin(spark, ledger, run_id, as_of, f"{folder}/file", keys, select)
    if intent is None:
        return nothing_to_export(spark, DEFAULT_ROUTE)
    staged = _staged_orders(spark, intent.audience)

    def write(route: str) -> None:
        rows = staged.filter(F.col("route_key") == route)

        def lines(path: str) -> bool:
            return write_exact(rows, exports.ORDER_KEYS, path, ["id"]) if exact else write_routed(rows, exports.ORDER_KEYS, path)

        _write_once(spark, intent.folder(route), resumed, lines)

    settled = resumed and storage.complete(spark, f"{ledger}/run_id={run_id}")
    outcomes = [_attempt(route, lambda route=route: None if settled else write(route)) for route in intent.routes]
    counted = settle(spark, ledger, intent)
    lost = {row.route_key for row in counted.filter("is_error").collect()}
    # The ledger decides: a file that was written here but does not count there is reported, too.
    elsewhere = [(route, True, SETTLED_ELSEWHERE, WRITE_FAILED) for route, is_error, *_ in outcomes if route in lost and not is_error]
    others = {route for route, *_ in elsewhere}
    status = _status(spark, [outcome for outcome in outcomes if outcome[0] not in others] + elsewhere)
    failed = None
    if create_activity:
        written = staged.join(status.filter(~F.col("is_error")), "route_key", "left_semi")
        contacts = written.select(F.col("source_contact_id").alias("contact_id"))
        failed = _follow_up(t, contacts, out, run_id, as_of, subject, ORDER_CAMPAIGN)
    where = F.concat(F.lit(f"{intent.files}-"), F.col("route_key"))
    return summary(staged, routes, as_of, status, report_empty=False, follow_up_error=failed, folder=where)
