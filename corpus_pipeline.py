"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockpolicy.functions.session import release, stored
from stockpolicy.llm import mixing, near_dedup, packing, quality_rules, secret_scan

# The near-duplicate stage uses the shingle length and distance of the operator's contract.
SHINGLE, RADIUS = 3, 2


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.drop_near_duplicates(docs, SHINGLE, RADIUS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each document that the mix takes."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequence and place."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # SimHash, the network, permutations and packing are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        release(before)
    return docs
