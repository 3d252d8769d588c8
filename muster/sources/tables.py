"""Reading the CRM tables: stored tables, custom fields, routes, pending orders."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.operators.lookups import option_code
from muster.schemas import SCHEMAS

ROUTES_TYPE = "map<string,struct<file:string,remote:string>>"
DEFAULT_ROUTE = "default"
ORDER_ACTIVITY = "Webshop Order"


def conform(df: DataFrame, schema: T.StructType, collation: str | None = None) -> DataFrame:
    """The contract's columns in the contract's types; a missing column is an error.

    With a ``collation`` (say ``UTF8_LCASE``) every comparison of these texts follows it.
    """
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if collation is not None:
        schema = T.StructType([_collated(field, collation) for field in schema])
    return df.to(schema)


def _collated(field: T.StructField, collation: str) -> T.StructField:
    if isinstance(field.dataType, T.StringType):
        return T.StructField(field.name, T.StringType(collation), field.nullable)
    return field


class LazyTables(dict):
    """Table name -> DataFrame; a table is opened on first use, so a job touches only what it needs."""

    def __init__(self, open_table: Callable[[str], DataFrame], collation: str | None = None):
        super().__init__()
        self._open = open_table
        self._collation = collation

    def __missing__(self, name: str) -> DataFrame:
        self[name] = conform(self._open(name), SCHEMAS[name], self._collation)
        return self[name]


def load_tables(
    spark: SparkSession, directory: str, fmt: str = "parquet", collation: str | None = None
) -> LazyTables:
    """The tables of the contract, each stored as ``<directory>/<table>.<fmt>``.

    The stored schema is read and checked against the contract, so that a missing column fails and does not
    turn into NULLs. Texts are compared byte by byte unless a collation is given.
    """
    return LazyTables(lambda name: spark.read.format(fmt).load(f"{directory}/{name}.{fmt}"), collation)


def rename_custom(df: DataFrame, field_map: Mapping[str, int]) -> DataFrame:
    """Give ``custom_<id>`` columns the name of their custom field (``field_map``: name -> id)."""
    missing = [name for name, field_id in field_map.items() if f"custom_{field_id}" not in df.columns]
    if missing:
        raise ValueError(f"custom fields without a column: {', '.join(missing)}")
    return df.withColumnsRenamed({f"custom_{field_id}": name for name, field_id in field_map.items()})


def routes(spark: SparkSession, setting: str) -> DataFrame:
    """The JSON setting ``{route: {file, remote}}`` as rows (route_key, file, remote).

    The setting is a single configuration value, so its check for a default route is made at once, without a job.
    """
    try:
        keys = json.loads(setting)
    except json.JSONDecodeError:
        keys = None
    if not isinstance(keys, dict) or DEFAULT_ROUTE not in keys:
        raise ValueError(f"the routes hold no '{DEFAULT_ROUTE}' entry")
    parsed = spark.range(1).select(F.from_json(F.lit(setting), ROUTES_TYPE).alias("routes"))
    return parsed.select(F.explode("routes").alias("route_key", "target")).select(
        "route_key", F.col("target.file").alias("file"), F.col("target.remote").alias("remote")
    )


def pending_orders(t: Mapping[str, DataFrame], type_name: str = ORDER_ACTIVITY) -> DataFrame:
    """Paid orders that were not exported yet. A NULL flag does not match."""
    orders = t["webshop_order"]
    return orders.filter(
        (F.col("activity_type_id") == option_code(t, "activity_type", type_name))
        & (F.col("payment_received") == 1)
        & (F.col("order_exported") == 0)
    )
