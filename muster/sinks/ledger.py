"""The ledger of exported orders: what a run intends is written down before its files, what it did after them.

``<ledger>`` holds the exported orders, a part ``run_id=<run_id>`` for each settled run. ``<ledger>-log`` holds one numbered
entry for each run that began: its run id, the staged audience (which orders by route) and the folder of its files. An entry is
made by creating the file of the next number, which must not exist; a run that comes second reads the first one's
entry and takes the orders that are left. So each order belongs to one run, whatever runs begin at once.

A route's files count as exported once their folder is marked as complete. Settling a run reads these marks: orders of complete
routes enter the ledger, files of other routes are removed and their orders are pending again. The run settles itself at its end;
if it died, the next run does so, and comes to the same result from the same marks.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions.dates import moment
from muster.sinks import storage
from muster.sources.local import local_rows

# Fixed value: status of an order that has been exported.
COMPLETED = 2

LEDGER = "id bigint, order_exported int, order_exported_date timestamp_ntz, status_id int"
TAKEN = "id bigint, route_key string"
#: A run that began so long ago and is not settled is taken for dead.
PATIENCE = timedelta(days=1)


def mark_exported(orders: DataFrame, write_status: DataFrame, as_of: datetime) -> DataFrame:
    """Ledger rows for the orders (id, route_key) whose route was written: (route_key, is_error) says which.

    Orders of a failed route, or of one without a status, stay pending.
    """
    written = write_status.filter(~F.col("is_error")).select("route_key")
    return orders.join(written, "route_key", "left_semi").select(
        "id",
        F.lit(1).alias("order_exported"),
        moment(as_of).alias("order_exported_date"),
        F.lit(COMPLETED).alias("status_id"),
    )


def not_in_ledger(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    return orders.join(ledger.select("id"), "id", "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger rows of all earlier runs; empty before the first one."""
    try:
        return spark.read.schema(LEDGER).parquet(path).select("id", "order_exported", "order_exported_date", "status_id")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return local_rows(spark, [], LEDGER)


@dataclass(frozen=True)
class Intent:
    """What a run is about to export: its staged orders (id, route_key, ...) and, by route, the folders of its files."""

    run_id: str
    audience: str
    files: str
    as_of: str
    routes: tuple[str, ...]

    def folder(self, route: str) -> str:
        return f"{self.files}-{route}"

    def orders(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TAKEN).parquet(self.audience)

    def status(self, spark: SparkSession) -> DataFrame:
        """(route_key, is_error) by the marks of the routes' folders. Routes are a setting, a handful of keys."""
        found = [(route, not storage.complete(spark, self.folder(route))) for route in self.routes]
        return local_rows(spark, found, "route_key string, is_error boolean")


def _entries(spark: SparkSession, ledger: str) -> tuple[list[str], set[str]]:
    """The log's entries in order, and those that are settled."""
    paths = storage.find(spark, f"{ledger}-log/*")
    settled = {path.removesuffix(".settled") for path in paths if path.endswith(".settled")}
    return [path for path in paths if not path.endswith(".settled")], settled


def _intent(spark: SparkSession, entry: str) -> Intent:
    said = json.loads(storage.note(spark, entry))
    return Intent(**{**said, "routes": tuple(said["routes"])})


def open_intents(spark: SparkSession, ledger: str) -> dict[str, Intent]:
    """By log entry, the intents of runs that are not settled."""
    entries, settled = _entries(spark, ledger)
    return {entry: _intent(spark, entry) for entry in entries if entry not in settled}


def find_intent(spark: SparkSession, ledger: str, run_id: str) -> Intent | None:
    """What a run of this id has entered; None before its entry."""
    found = [intent for intent in open_intents(spark, ledger).values() if intent.run_id == run_id]
    if not found and storage.complete(spark, f"{ledger}/run_id={run_id}"):
        found = [intent for intent in map(lambda entry: _intent(spark, entry), _entries(spark, ledger)[0]) if intent.run_id == run_id]
    return found[0] if found else None


def taken(spark: SparkSession, ledger: str) -> DataFrame:
    """(id) of every order that is exported, or that a run which is not settled holds."""
    held = [intent.orders(spark).select("id") for intent in open_intents(spark, ledger).values()]
    return reduce(DataFrame.unionByName, held, read_ledger(spark, ledger).select("id"))


def begin(
    spark: SparkSession, ledger: str, run_id: str, as_of: datetime, files: str, routes: list[str], select: Callable[[DataFrame], str | None]
) -> Intent | None:
    """Enter a run into the log before its first file; None if it has no order.

    ``select`` stages the run's orders without those it is given and returns their folder (None: there are none). It is
    asked again if another run made an entry meanwhile.
    """
    while True:
        entries, _ = _entries(spark, ledger)
        audience = select(taken(spark, ledger))
        if audience is None:
            return None
        intent = Intent(run_id, audience, files, as_of.isoformat(), tuple(routes))
        number = int(entries[-1].rsplit("/", 1)[1]) + 1 if entries else 1
        if storage.claim(spark, f"{ledger}-log/{number:012d}", json.dumps(asdict(intent))):
            return intent


def settle(spark: SparkSession, ledger: str, intent: Intent) -> DataFrame:
    """Write a run's ledger rows by the marks of its files and remove what is not marked; returns the routes' status.

    A run that is settled twice gets the same rows: its part is replaced. A route that its run completes after another run settled it
    is removed by the run itself: the ledger's part decides.
    """
    part = f"{ledger}/run_id={intent.run_id}"
    status = intent.status(spark)
    if storage.complete(spark, part):
        # Settled by another run, which took this one for dead: files that it did not find do not count.
        done = spark.read.schema(LEDGER).parquet(part)
        exported = intent.orders(spark).join(done.select("id"), "id", "left_semi").select("route_key").distinct()
        counted = {row.route_key for row in exported.collect()}
        status = local_rows(spark, [(route, route not in counted) for route in intent.routes], "route_key string, is_error boolean")
    else:
        mark_exported(intent.orders(spark), status, datetime.fromisoformat(intent.as_of)).write.mode("overwrite").parquet(part)
        storage.mark_complete(spark, part)
    for row in status.filter("is_error").collect():
        storage.delete(spark, intent.folder(row.route_key))
    for entry, other in open_intents(spark, ledger).items():
        if other.run_id == intent.run_id:
            storage.claim(spark, f"{entry}.settled")
    return status


def recover(spark: SparkSession, ledger: str, patience: timedelta = PATIENCE, but: str | None = None) -> list[str]:
    """Settle the runs that began ``patience`` ago or earlier and did not settle themselves (``but`` one); returns their ids.

    ``patience`` must be longer than any run takes: a run that is settled while it still writes loses the routes it has not
    completed, and says so.
    """
    over = []
    for entry, intent in open_intents(spark, ledger).items():
        if intent.run_id != but and storage.age_seconds(spark, entry) >= patience.total_seconds():
            settle(spark, ledger, intent)
            over.append(intent.run_id)
    return over
