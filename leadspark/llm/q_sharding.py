"""Registered query of the sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import sharding
from leadspark.llm.registry import query


@query("op7_lpt_sharding")
def lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.deal(spark.read.parquet(f"{sf_dir}/documents.parquet"))
