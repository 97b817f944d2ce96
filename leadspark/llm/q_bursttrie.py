"""Registered query of the conversation trie, beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import bursttrie
from leadspark.llm.registry import query

SQL = r"""
WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                  substring(to_base64(unhex(md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')))), 1, 22) AS id
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM t),
c AS (SELECT conv_id, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substring(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
f AS (SELECT c.conv_id, p.pos, p.id, p.chars FROM c JOIN p ON p.conv_id = c.conv_id - c.conv_id % 100 AND p.pos < c.h),
lb AS (SELECT c.conv_id, h, count(f.pos) AS n FROM c LEFT JOIN f USING (conv_id) GROUP BY ALL),
r AS (SELECT conv_id, pos, id, chars FROM f UNION ALL SELECT conv_id, pos - h + n, id, chars FROM p JOIN lb USING (conv_id) WHERE pos >= h),
k AS (SELECT conv_id, pos + 1 AS d, chars, md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c),
u AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY d) AS up, lead(key) OVER (PARTITION BY conv_id ORDER BY d) AS next FROM k),
n AS (SELECT d, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, count(DISTINCT next) AS n_children, (count(*) - 1) * any_value(chars) AS own,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE next IS NULL), '') AS ends FROM u GROUP BY d, key),
s AS (SELECT k.d, k.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own) AS saved FROM n JOIN k ON k.conv_id = n.conv_id AND k.d <= n.d GROUP BY k.d, k.key)
SELECT n.conv_id, n.d AS depth, above.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.d = n.d AND s.key = n.key LEFT JOIN n AS above ON above.d = n.d - 1 AND above.key = n.up
"""


@query("op13_conversation_trie", SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursttrie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
