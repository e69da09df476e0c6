"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpolicy.functions.session import ensure_workspace
from stockpolicy.llm import (
    fingerprints,
    html_extract,
    merkle,
    mixing,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_groups,
    toxicity,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_workspace(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality_classifier.train(docs, quality_classifier.graded(labels))
    return quality_classifier.score(docs, model)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    fingerprint = near_dedup.hexadecimal(F.col("fp")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampering_check(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(_table(spark, sf_dir, "embeddings"))
    # A long holds it while n * n * trace does; beyond that the operator's decimal is needed.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.jaccard_components(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(ensure_workspace(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_quality_classifier,
        op2_quality_rules,
        op3_substring_dedup,
        op4_secret_scan,
        op5_fingerprints,
        op6_packing,
        op7_mixing,
        op8_near_dedup,
        op9_html_extract,
        op10_toxicity,
        op11_merkle,
        op12_whitening,
        op13_jaccard_join,
        pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality_rules.oracle(),
        "op11_merkle": merkle.oracle(),
        "op13_jaccard_join": token_groups.oracle(),
    }
