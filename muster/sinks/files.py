"""Delimited files: one folder of part files per file, or one folder per route."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions.text import csv_field, csv_line

SEPARATOR = ";"
# Spark's defaults would trim blanks, write "" for '' and put a backslash before a quote.
CSV_OPTIONS = {
    "sep": SEPARATOR,
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}


def write_csv(df: DataFrame, keys: Sequence[str], path: str) -> bool:
    """Write the columns of ``keys``; False, and no file, when there are no rows. Each part has a header."""
    if df.isEmpty():
        return False
    df.select(*keys).write.options(**CSV_OPTIONS).csv(path)
    return True


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read such a file back; an empty field comes back as NULL."""
    options = {**CSV_OPTIONS, "multiLine": "true"}
    return spark.read.schema(schema).options(**options).csv(path)


def csv_lines(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows as finished lines in the byte-exact form (one column ``value``)."""
    return df.select(csv_line([F.col(key) for key in keys], SEPARATOR).alias("value"))


def write_csv_lines(df: DataFrame, keys: Sequence[str], path: str) -> bool:
    """Byte-exact form: ``path/header`` and ``path/lines``; concatenated they are the file."""
    if df.isEmpty():
        return False
    spark = df.sparkSession
    header = spark.range(1).select(F.concat_ws(SEPARATOR, *[csv_field(F.lit(key)) for key in keys]).alias("value"))
    header.write.text(f"{path}/header")
    csv_lines(df, keys).write.text(f"{path}/lines")
    return True


def write_exact(df: DataFrame, keys: Sequence[str], path: str, order: Sequence[str]) -> bool:
    """Byte-exact form in one folder: its parts, one after the other by name, are the file; False without rows.

    Lines are sorted by ``order``, then by themselves, over as many tasks as there are partitions; the header sorts before
    all, so it is the first line of the first part. The bytes are those of a single writer, however many parts there are (up to
    100,000, whose names sort as their numbers do).
    """
    if df.isEmpty():
        return False
    places = [F.col(column).alias(f"_order{at}") for at, column in enumerate(order)]
    lines = df.select(F.lit(1).alias("_kind"), *places, csv_line([F.col(key) for key in keys], SEPARATOR).alias("value"))
    header = F.concat_ws(SEPARATOR, *[csv_field(F.lit(key)) for key in keys]).alias("value")
    empty = [F.lit(None).cast(lines.schema[f"_order{at}"].dataType).alias(f"_order{at}") for at in range(len(places))]
    whole = df.sparkSession.range(1).select(F.lit(0).alias("_kind"), *empty, header).unionByName(lines)
    whole.orderBy(*whole.columns).select("value").write.text(path)
    return True


def write_routed(df: DataFrame, keys: Sequence[str], path: str, max_rows_per_file: int = 0) -> bool:
    """One folder ``route_key=<route>`` per route; False, and no file, when there are no rows.

    Rows are rebalanced by route: a route that holds most of them is split over several tasks, small ones share
    files. ``max_rows_per_file`` additionally bounds the part files (0: unbounded).
    """
    if df.isEmpty():
        return False
    (
        df.select(*keys, "route_key")
        .hint("rebalance", "route_key")
        .write.options(**CSV_OPTIONS, maxRecordsPerFile=max_rows_per_file)
        .partitionBy("route_key")
        .csv(path)
    )
    return True
