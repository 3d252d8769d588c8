"""The operators as registered queries over the given tables, and the expected rows where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from muster.llm import (
    blob_ledger,
    containment,
    context_mixing,
    divergence,
    fill_in_middle,
    forest_dedup,
    importance,
    language,
    lookup_shards,
    mixing,
    nn_descent,
    oracles,
    surrogates,
    token_planes,
)
from muster.llm.common import Stage, table

Query = Callable[[SparkSession, str], DataFrame]

#: Shards that op6 places documents on.
SHARDS = [f"shard-{number:03d}" for number in range(128)]


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings")).drop("audit_links")


def op2_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    found = blob_ledger.scan(table(spark, sf_dir, "documents"), ["doc_id"], f"{stage.folder}/ledger", stage=stage)
    return blob_ledger.report(found)


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_corpus(table(spark, sf_dir, "documents"))


def op5_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_lookup_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard by its id, and by its source, where frequent sources are split."""
    placed = lookup_shards.place(table(spark, sf_dir, "documents").select("doc_id", "source"), SHARDS, ["doc_id"])
    placed = placed.withColumnsRenamed({"slot": "id_slot", "shard": "id_shard"})
    evenly = lookup_shards.place_evenly(placed, SHARDS, ["source"], ["doc_id"])
    return evenly.select("doc_id", F.col("id_slot").alias("slot"), F.col("id_shard").alias("shard"), F.col("shard").alias("source_shard"), F.col("parts").alias("source_parts"))


def op7_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id"), 5, 0))
    fitted = language.sample(docs.filter(~F.col("held_out")))
    return language.predict(docs, fitted, ["doc_id", "held_out"])


def op9_byte_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.round_trip(table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col("found")[kind].cast("long").alias(f"n_{kind}") for kind in surrogates.PATTERNS]
    return replaced.select("doc_id", *counts, "text")


def op11_secondary_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op13_arrow_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Query]:
    listed = [
        op1_nn_descent,
        op2_blob_ledger,
        op3_minhash_forest,
        op4_context_mixing,
        op5_weighted_mix,
        op6_lookup_shards,
        op7_benchmark_containment,
        op8_cross_parsing,
        op9_byte_planes,
        op10_surrogates,
        op11_secondary_sort,
        op12_divergence,
        op13_arrow_resampling,
    ]
    return {query.__name__: query for query in listed} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
