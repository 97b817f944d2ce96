"""Registered query of the HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import htmltext
from leadspark.llm.registry import query


@query("op6_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
