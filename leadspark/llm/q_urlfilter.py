"""Registered query of the URL filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import urlfilter
from leadspark.llm.registry import query

RULES = (
    urlfilter.Rule("com/", "allow"),
    urlfilter.Rule("example.com/en/", "block"),
    urlfilter.Rule("www.example.com/en/", "allow"),
    urlfilter.Rule("net/es/", "block"),
    urlfilter.Rule("net/fr/", "block"),
)


@query("op9_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, urlfilter.labelled(spark))
