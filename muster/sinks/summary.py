"""What a run wrote, per file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators.aggregates import count_by
from muster.sources.local import local_rows

NO_DATA = "No data available for upload"
NO_DATA_CODE = 1
NO_ORDERS = "No valid activities found for export"
SUMMARY = (
    "route_key string, count bigint, filename string, folder string, is_error boolean, message string, error_code int,"
    " follow_up_error string"
)


def file_name(as_of: datetime):
    return F.concat(F.col("file"), F.lit(f"_{as_of:%Y%m%d%H%M%S}.csv"))


def nothing_to_export(spark: SparkSession, route: str) -> DataFrame:
    """The summary of an order run without orders."""
    return local_rows(spark, [(route, 0, None, None, True, NO_ORDERS, NO_DATA_CODE, None)], SUMMARY)


def records_only(spark: SparkSession, route: str, count: int, follow_up_error: str | None) -> DataFrame:
    """The summary of a run that writes no file, only follow-up records for ``count`` contacts."""
    return local_rows(spark, [(route, count, None, None, False, None, 0, follow_up_error)], SUMMARY)


def summary(
    df: DataFrame,
    routes: DataFrame,
    as_of: datetime,
    write_status: DataFrame | None = None,
    report_empty: bool = True,
    follow_up_error: str | None = None,
    folder: Column | None = None,
) -> DataFrame:
    """Per route: row count, file name, error flag, message and code, and why the run's follow-up records failed.

    ``filename`` is the name that the file is to be delivered under, ``folder`` (by ``route_key``) where its parts lie; it is
    null where nothing was written. A route without rows is an error, or is left out when ``report_empty`` is off. ``write_status``
    (route_key, message, error_code) brings the errors met while writing.
    """
    found = count_by(df, "route_key").join(routes.select("route_key", "file"), "route_key", "right")
    if not report_empty:
        found = found.filter(F.col("count").isNotNull())
    if write_status is None:
        found = found.withColumns({"_message": F.lit(None).cast("string"), "_code": F.lit(None).cast("int")})
    else:
        errors = write_status.select(
            "route_key", F.col("message").alias("_message"), F.col("error_code").cast("int").alias("_code")
        )
        found = found.join(errors, "route_key", "left")
    empty = F.col("count").isNull()
    failed = empty | (F.coalesce("_code", F.lit(0)) != 0)
    return found.select(
        "route_key",
        F.coalesce("count", F.lit(0)).alias("count"),
        file_name(as_of).alias("filename"),
        F.when(~failed, F.lit(None) if folder is None else folder).cast("string").alias("folder"),
        failed.alias("is_error"),
        F.when(empty, F.lit(NO_DATA)).otherwise(F.col("_message")).alias("message"),
        F.when(empty, F.lit(NO_DATA_CODE)).otherwise(F.coalesce("_code", F.lit(0))).alias("error_code"),
        F.lit(follow_up_error).cast("string").alias("follow_up_error"),
    )
