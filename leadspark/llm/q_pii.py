"""Registered query of the personal data scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import pii
from leadspark.llm.registry import query


@query("op11_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
