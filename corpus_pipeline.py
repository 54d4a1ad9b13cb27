"""Corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import decontam, mixing, neardup, quality, sharding
from tabml.llm.queries import turning_weights
from tabml.sources.scratch import stored

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules of texts and hosts."""
    return quality.judged(docs).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return neardup.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by `benchmark`."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights; a document taken twice is there twice."""
    mix = mixing.mixed(docs, F.array("source"), turning_weights, mixing.word_count(F.col("text")), key=["doc_id", "text"])
    times = F.when(F.col("taken") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return mix.rows.select("row", F.explode(F.array_repeat(F.lit(0), times)).alias("turn")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns of the documents, with their shard and their slot in it."""
    placed = sharding.sharded(docs, SHARDS, key=["doc_id"])
    return placed.select("row.*", F.col("size").alias("shard_bytes"), "shard", "slot")


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
