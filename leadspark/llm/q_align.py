"""Registered query of the cross-tokenizer alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import align
from leadspark.llm.registry import query


@query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
