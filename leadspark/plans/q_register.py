"""Commercial-register cube and dashboard views."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date
from leadspark.operators import register as R
from leadspark.registry import query
from leadspark.sources.tables import REGISTER_SQL, register_events

CUBE_SQL = (
    "WITH "
    + REGISTER_SQL
    + """,
counts AS (
  SELECT date_trunc('month', publication_date) AS m, CASE WHEN grouping(kanton) = 1 THEN 'CH' ELSE 'KT' END AS geo, kanton, shab_id, count(*) AS c
  FROM shab GROUP BY GROUPING SETS ((date_trunc('month', publication_date), kanton, shab_id), (date_trunc('month', publication_date), shab_id))
),
wide AS (
  SELECT m, geo, kanton, CAST(sum(CASE WHEN shab_id = 'HR01' THEN c ELSE 0 END) AS BIGINT) AS "HR01",
    CAST(sum(CASE WHEN shab_id = 'HR03' THEN c ELSE 0 END) AS BIGINT) AS "HR03" FROM counts GROUP BY m, geo, kanton
),
cube_rows AS (
  SELECT strftime(m, '%Y-%m-%d') AS month, geo, kanton, shab_id AS hr, c AS "count" FROM counts
  UNION ALL SELECT strftime(m, '%Y-%m-%d'), geo, kanton, 'NET', "HR01" - "HR03" FROM wide
)
"""
)


def _cube(spark, sf):
    return R.monthly_cube(register_events(spark, sf))


def _month(df):
    return df.withColumn("month", iso_date(F.col("month")))


@query("agg_month_canton", CUBE_SQL + "SELECT month, kanton, hr, \"count\" FROM cube_rows WHERE geo = 'KT' AND hr <> 'NET'")
def agg_month_canton(spark, sf):
    return _month(R.counts_by_canton(register_events(spark, sf))).withColumnRenamed("shab_id", "hr")


@query("agg_month_total", CUBE_SQL + "SELECT month, geo, kanton, hr, \"count\" FROM cube_rows WHERE hr <> 'NET'")
def agg_month_total(spark, sf):
    return _month(R.monthly_counts(register_events(spark, sf))).withColumnRenamed("shab_id", "hr")


@query("agg_pivot", CUBE_SQL + "SELECT strftime(m, '%Y-%m-%d') AS month, geo, kanton, \"HR01\", \"HR03\" FROM wide")
def agg_pivot(spark, sf):
    return _month(R.by_type(R.monthly_counts(register_events(spark, sf)))).drop(R.NET)


@query("agg_net", CUBE_SQL + "SELECT strftime(m, '%Y-%m-%d') AS month, geo, kanton, \"HR01\" - \"HR03\" AS \"NET\" FROM wide")
def agg_net(spark, sf):
    return _month(R.by_type(R.monthly_counts(register_events(spark, sf)))).drop(R.ENTRY, R.DELETION)


@query("agg_unpivot", CUBE_SQL + "SELECT month, geo, kanton, hr, \"count\" FROM cube_rows WHERE hr = 'NET'")
def agg_unpivot(spark, sf):
    return _month(R.net_long(R.by_type(R.monthly_counts(register_events(spark, sf))))).withColumnRenamed("shab_id", "hr")


@query("srt_cube", CUBE_SQL + "SELECT month, geo, kanton, hr, \"count\" FROM cube_rows ORDER BY month, geo, kanton NULLS LAST, hr")
def srt_cube(spark, sf):
    return R.ordered_cube(_cube(spark, sf))


@query("agg_dims", CUBE_SQL + """SELECT 'HR01,HR03,NET' AS metrics, string_agg(DISTINCT kanton, ',' ORDER BY kanton) AS cantons,
  string_agg(DISTINCT month, ',' ORDER BY month) AS months FROM cube_rows""")
def agg_dims(spark, sf):
    d = R.dimensions(_cube(spark, sf))
    return d.select(*[F.array_join(c, ",").alias(c) for c in ("metrics", "cantons", "months")])


@query("agg_status", CUBE_SQL + "SELECT count(*) AS records, count(DISTINCT month) AS months_covered, count(DISTINCT kanton) AS cantons_covered FROM cube_rows")
def agg_status(spark, sf):
    return R.status(_cube(spark, sf))


LAST12 = ", vis AS (SELECT DISTINCT month FROM cube_rows ORDER BY month DESC LIMIT 12) "


@query("flt_dashboard", CUBE_SQL + LAST12 + "SELECT month, geo, kanton, hr, \"count\" FROM cube_rows WHERE geo = 'KT' AND kanton = 'NATION_3' AND hr = 'NET' AND month IN (SELECT month FROM vis)")
def flt_dashboard(spark, sf):
    return R.dashboard_rows(_cube(spark, sf), R.NET, 12, R.CANTON, "NATION_3").select("month", "geo", "kanton", "hr", "count")


@query("win_month_index", CUBE_SQL + "SELECT month, CAST(dense_rank() OVER (ORDER BY month DESC) AS BIGINT) AS position FROM (SELECT DISTINCT month FROM cube_rows)")
def win_month_index(spark, sf):
    return R.month_positions(_cube(spark, sf)).withColumn("position", F.col("position").cast("long"))


@query(
    "join_lookup_pivot",
    CUBE_SQL + LAST12 + """SELECT g.kanton, g.month, coalesce(c."count", 0) AS "count"
FROM (SELECT k.kanton, v.month FROM (SELECT DISTINCT kanton FROM cube_rows WHERE kanton IS NOT NULL) k CROSS JOIN vis v) g
LEFT JOIN cube_rows c ON c.geo = 'KT' AND c.hr = 'HR01' AND c.kanton = g.kanton AND c.month = g.month""",
)
def join_lookup_pivot(spark, sf):
    return R.heat_map(_cube(spark, sf), R.ENTRY, 12)


@query(
    "join_ts_gapfill",
    CUBE_SQL + """SELECT v.month, coalesce(c."count", 0) AS "count" FROM (SELECT DISTINCT month FROM cube_rows) v
LEFT JOIN cube_rows c ON c.geo = 'KT' AND c.kanton = 'NATION_7' AND c.hr = 'HR03' AND c.month = v.month""",
)
def join_ts_gapfill(spark, sf):
    return R.time_series(_cube(spark, sf), R.DELETION, 0, R.CANTON, "NATION_7")
