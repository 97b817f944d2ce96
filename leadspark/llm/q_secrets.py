"""Registered query of the secret scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import secrets
from leadspark.llm.registry import query


@query("op2_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
