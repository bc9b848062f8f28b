"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Toxic documents go, one document of each SimHash group stays, documents with benchmark passages
go, sources are mixed to their target weights, and what is left is dealt to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontamination, mixing, simhash, toxicity
from riskspark.llm.common import documents, table
from riskspark.llm.queries import shards_of


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, documents(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards_of(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The CRF's scores, XXH64 fingerprints and hashed draws have no SQL form; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
