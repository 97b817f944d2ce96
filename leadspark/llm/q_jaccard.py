"""Registered query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import jaccard
from leadspark.llm.registry import query


@query("op5_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.group(spark.read.parquet(f"{sf_dir}/documents.parquet"))
