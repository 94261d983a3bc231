"""From raw documents to training shards: five stages, each one of the operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet and read
again before the next stage, so that a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.llm import decontaminate, importance, mixing, near_dup, sharding
from zonal.llm.common import free_name
from zonal.operators.staging import stage

SHARDS = 24


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; those it rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, model = importance.resample(docs, labels)
    return importance.select(docs, model)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id. Documents
    without an id are compared to others but have no place in a group, and stay."""
    found = near_dup.near_duplicates(docs)
    name = free_name(docs, "gone_id")
    gone = stage(found.where("not kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix in its order: a document as often as its source's target takes it."""
    return mixing.mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix with its shard and slot."""
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shards),
]

# Neither the sample nor the shuffle is an SQL expression; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
