"""A training corpus from ``documents``: five stages, each written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import containment, forest_dedup, language, mixing, token_planes
from muster.llm.common import Stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, which becomes their ``lang``; null and empty texts and those without any letter go.

    Repeated rows stay as often as they come, rows without doc_id are told like others, and an empty table gives none.
    """
    fitted = language.sample(docs.filter(~language.held_out(F.col("doc_id"), 5, 0)))
    found = language.predict(docs, fitted).filter(F.col("lang_pred") != language.UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest doc_id, once.

    Of rows that share an id one stays, any of them where their texts differ: such texts are one group. Texts without a word
    are groups of their own. Rows without doc_id belong to no group and all stay.
    """
    kept = forest_dedup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. All rows of an id go if one of them holds one; null ids are one such id."""
    hits = containment.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    hits = Stage(spark)(hits).withColumnRenamed("doc_id", "hit")
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["hit"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: texts without a word go, null sources are a source, null ids one document."""
    return mixing.repeat(docs, table(spark, sf_dir, "labels"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids on disk; a row for every document read back from the files. Null and empty texts are an end id."""
    return token_planes.round_trip(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Language models, MinHash and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    stage = Stage(spark)
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
