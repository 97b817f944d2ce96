"""Registered query of the decontamination, beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import decontam
from leadspark.llm.registry import query

_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
phrases AS (
  SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT item, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
spots AS (SELECT row, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM phrases)),
found AS (SELECT row, i, k, item FROM (SELECT row, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM spots) JOIN phrases USING (k, g)),
hit AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + k)) AS p FROM found) GROUP BY row),
own AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN own USING (row)
"""


@query("op8_benchmark_decontamination", SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("items")
