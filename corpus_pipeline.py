"""Corpus preparation: each stage works on all that the one before kept, stored as Parquet in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import decontam, jaccard, linefreq, packing, secrets
from leadspark.session import scratch_path

#: SQL can't express the trained automata, the tokenizer and the packing; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and so do the common lines of all others."""
    return linefreq.clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by five-word shingles at a similarity of 0.75 or more, the one with the least doc_id stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark phrases are cut out; documents that consist of nothing else go."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", jaccard_join),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage's rows are stored below ``spark.checkpoint.dir`` and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
