"""Registered query of the packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import packing
from leadspark.llm.registry import query


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
