"""Where a run keeps its staged tables."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from muster.sinks import storage


def run_folder(spark: SparkSession) -> str:
    """A new folder in shared storage, below ``spark.checkpoint.dir`` or else the session's warehouse folder.

    The warehouse's default is a folder of the driver's machine, which the executors of a cluster do not reach: without
    ``spark.checkpoint.dir`` such a folder is refused unless driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir", None)
        local = spark.conf.get("spark.master", "").split("[")[0] == "local"
        if not shared or (urlparse(shared).scheme in ("", "file") and not local):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{shared.rstrip('/')}/muster-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write the rows once and read them back, so that file, links and counts see the same rows.

    ``by`` names a column with few values: rows are kept apart by it, so reading one value reads only its files.
    A folder that is marked as complete is read as it is: a run that is tried again goes on from there. What an interrupted
    try has left is replaced.
    """
    spark = df.sparkSession
    if not storage.complete(spark, path):
        if by is None:
            df.write.mode("overwrite").parquet(path)
        else:
            df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
        storage.mark_complete(spark, path)
    return spark.read.schema(df.schema).parquet(path)
