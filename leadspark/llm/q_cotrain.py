"""Registered query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import cotrain
from leadspark.llm.registry import query


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
