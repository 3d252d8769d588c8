"""Adding rows to a table that may hold some of them, so that a repeated run adds nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from muster.operators.updates import insert_new
from muster.sinks import storage
from muster.sinks.place import stage
from muster.sources.local import local_rows


def read_parts(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows of all complete parts of a target; none before the first one."""
    parts = [path.rsplit("/", 1)[0] for path in storage.find(spark, f"{target}/run_id=*/{storage.COMPLETE}")]
    if not parts:
        return local_rows(spark, [], schema)
    return spark.read.schema(schema).parquet(*parts)


def append_new(rows: DataFrame, target: str, key: Sequence[str], run_id: str, base: DataFrame | None = None) -> DataFrame:
    """Append the rows whose key neither ``base`` nor another run's part of ``target`` holds; returns those of this run.

    Of rows with one key one is added. Each run has a part of its own, ``run_id=<run_id>``, which counts once it is marked as
    complete. A run that is repeated finds its part and adds nothing; an interrupted one replaces what it left. Two runs
    at once do not see each other's rows: keys must tell runs apart, or runs must follow each other. A null in a key equals no other.
    """
    held = read_parts(rows.sparkSession, target, rows.schema).select(*key)
    if base is not None:
        held = held.unionByName(base.select(*key))
    return stage(insert_new(held, rows, key), f"{target}/run_id={run_id}")
