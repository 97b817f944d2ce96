"""Registered query of the token files: written, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import tokenfile
from leadspark.llm.registry import query
from leadspark.session import scratch_path


@query("op4_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    tokenfile.write(spark.read.parquet(f"{sf_dir}/documents.parquet"), target)
    return tokenfile.read(spark, target)
