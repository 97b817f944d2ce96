"""Frames the registered queries share, and the same frames as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.operators.panel import PanelSpec, current_prospects, feature_frame, modeling_panel
from leadspark.sources.tables import COMPANIES_SQL, companies

SPEC = PanelSpec(as_of=datetime(1998, 12, 1))

# Groups of the test tables that stand for the segments a deployment names.
BIG_CANTONS = tuple(f"NATION_{i}" for i in range(5))
MAJOR_CANTONS = tuple(f"NATION_{i}" for i in range(10))
MAJOR_FORMS = ("BUILDING", "MACHINERY")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling_panel(companies(spark, sf_dir), SPEC)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_frame(panel(spark, sf_dir))


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_prospects(companies(spark, sf_dir), SPEC)


def with_demo_score(df: DataFrame) -> DataFrame:
    """Score in [0, 1) from whole numbers, so ties occur and every engine gets the same value."""
    mixed = (
        F.floor(F.coalesce(F.col("revenue"), F.lit(0.0)) / 20).cast("long")
        + F.coalesce(F.col("headcount"), F.lit(0.0)).cast("long") * 2
        + F.month("snapshot_date") * 3
    )
    return df.withColumn("score", (mixed % 1000) / F.lit(1000.0))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_key, company_id, snapshot_date, target, score) of the whole panel."""
    return with_demo_score(panel(spark, sf_dir)).select("row_key", "company_id", "snapshot_date", "target", "score")


SNAPSHOTS_SQL = """
snapshots AS (
  SELECT TIMESTAMP '1998-12-01 00:00:00' - to_months(n) AS snapshot_date
  FROM (VALUES (36), (30), (24), (18), (12)) t(n)
)
"""

PANEL_SQL = (
    COMPANIES_SQL
    + ","
    + SNAPSHOTS_SQL
    + """,
panel AS (
  SELECT c.*, s.snapshot_date,
    CASE WHEN c.joined_at IS NOT NULL AND c.joined_at >= s.snapshot_date
          AND c.joined_at < s.snapshot_date + INTERVAL 12 MONTH THEN 1 ELSE 0 END AS target,
    c.company_id * 1000000 + year(s.snapshot_date) * 100 + month(s.snapshot_date) AS row_key
  FROM companies c CROSS JOIN snapshots s
  WHERE s.snapshot_date <= TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 12 MONTH
    AND (c.joined_at IS NULL OR c.joined_at >= s.snapshot_date)
    AND (c.founding_year IS NULL OR c.founding_year <= year(s.snapshot_date))
    AND (c.deleted_at IS NULL OR c.deleted_at = DATE '1888-12-31' OR c.deleted_at > s.snapshot_date)
)
"""
)

CURRENT_SQL = (
    COMPANIES_SQL
    + """,
prospects AS (
  SELECT c.*, TIMESTAMP '1998-12-01 00:00:00' AS snapshot_date, c.company_id * 1000000 + 199812 AS row_key
  FROM companies c
  WHERE (c.joined_at IS NULL OR c.joined_at > TIMESTAMP '1998-12-01 00:00:00')
    AND (c.founding_year IS NULL OR c.founding_year <= 1998)
    AND (c.deleted_at IS NULL OR c.deleted_at = DATE '1888-12-31' OR c.deleted_at > TIMESTAMP '1998-12-01 00:00:00')
)
"""
)

SCORE_SQL = """
((CAST(floor(coalesce(revenue, 0) / 20) AS BIGINT) + CAST(coalesce(headcount, 0) AS BIGINT) * 2
  + month(snapshot_date) * 3) % 1000) / 1000.0::DOUBLE
"""

SCORED_SQL = (
    PANEL_SQL
    + f""",
scored AS (
  SELECT row_key, company_id, snapshot_date, target, CAST({SCORE_SQL} AS DOUBLE) AS score FROM panel
)
"""
)

FEATURES_SQL = (
    PANEL_SQL
    + """,
feat AS (
  SELECT t.*, ln(1 + company_age_years) AS company_age_log,
    CASE WHEN company_age_years <= 2 THEN 'startup' WHEN company_age_years <= 5 THEN 'early_growth'
         WHEN company_age_years <= 10 THEN 'established' WHEN company_age_years <= 20 THEN 'mature'
         ELSE 'legacy' END AS company_age_bucket,
    canton || '_' || noga_section AS canton_noga_section
  FROM (
    SELECT p.*,
      greatest(0, year(snapshot_date) - coalesce(founding_year, year(snapshot_date))) AS company_age_years,
      sin(2 * pi() * month(snapshot_date) / 12) AS month_sin,
      cos(2 * pi() * month(snapshot_date) / 12) AS month_cos,
      CASE WHEN month(snapshot_date) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end,
      CASE WHEN month(snapshot_date) IN (7, 8) THEN 1 ELSE 0 END AS is_summer,
      quarter(snapshot_date) AS quarter,
      CASE WHEN headcount IS NULL THEN 1 ELSE 0 END AS is_missing_headcount,
      CASE WHEN revenue IS NULL THEN 1 ELSE 0 END AS is_missing_revenue,
      ln(1 + greatest(coalesce(headcount, 0), 0)) AS headcount_log1p,
      ln(1 + greatest(coalesce(revenue, 0), 0)) AS revenue_log1p,
      coalesce(substr(postal_code, 1, 2), 'missing') AS plz2,
      coalesce(substr(postal_code, 1, 3), 'missing') AS plz3,
      coalesce(nullif(substr(trim(industry_code_06), 1, 1), ''), 'missing') AS noga_section,
      coalesce(nullif(regexp_extract(trim(industry_code_06), '^(\\d{2})', 1), ''), 'missing') AS noga_division,
      coalesce(nullif(regexp_extract(trim(industry_code_06), '^(\\d{3})', 1), ''), 'missing') AS noga_group
    FROM panel p
  ) t
)
"""
)
