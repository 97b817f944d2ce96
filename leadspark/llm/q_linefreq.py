"""Registered query of the quality rules, beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import linefreq
from leadspark.llm.registry import query

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
base AS (
  SELECT d.row, d.doc_id, d.host, d.t, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM d JOIN w USING (row)),
raw AS (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
win AS (SELECT row, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT row, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT row, g FROM win GROUP BY row, g HAVING count(*) > 1),
rep AS (SELECT row, count(DISTINCT p) AS n_repeat_words FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (row, g)) GROUP BY row),
lines AS (
  SELECT row, host, t, array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^\x20\x09-\x0D]+'), ' ') AS l
  FROM raw JOIN d USING (row) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
own AS (SELECT row, host, t, l, md5(l) AS h, sum(len(string_split(l, ' '))) AS words FROM lines GROUP BY row, host, t, l),
sizes AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
template AS (SELECT host, l FROM (SELECT host, l, count(DISTINCT t) AS c FROM own GROUP BY host, l) JOIN sizes USING (host) WHERE c > 20 AND 2 * c > docs),
told AS (SELECT own.*, template.l IS NOT NULL AS of_template FROM own LEFT JOIN template USING (host, l)),
low AS (SELECT row, list(h ORDER BY h)[1:2] AS hs, (list(h ORDER BY h) FILTER (WHERE NOT of_template))[1:2] AS os FROM told GROUP BY row),
anchored AS (
  SELECT told.*, coalesce(CASE WHEN h <> os[1] THEN os[1] ELSE os[2] END, CASE WHEN h <> hs[1] THEN hs[1] ELSE hs[2] END, h) AS anchor
  FROM told JOIN low USING (row)),
common AS (
  SELECT host, l FROM (SELECT host, l, count(DISTINCT anchor) AS c FROM anchored GROUP BY host, l) JOIN sizes USING (host)
  WHERE c > 20 AND c * 1000 > docs * 5),
lost AS (SELECT row, sum(words) AS n FROM own JOIN common USING (host, l) GROUP BY row)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
       coalesce(n_repeat_words, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words) AND (n_words - coalesce(n, 0)) * 100 >= n_words * 20 AS kept,
       CAST(coalesce(n, 0) AS BIGINT) AS n_common_words
FROM base LEFT JOIN dup USING (row) LEFT JOIN rep USING (row) LEFT JOIN lost USING (row)
"""


@query("op10_quality_rules", SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linefreq.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_common_words")
