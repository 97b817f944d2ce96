"""Sources, predicates, projections and joins of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark import schema as S
from leadspark.functions import features as X
from leadspark.functions.dates import add_months, iso_date
from leadspark.functions.hashing import hash32_sql
from leadspark.operators import panel as P
from leadspark.operators.ranking import random_rows
from leadspark.operators.splits import on_dates, split_dates
from leadspark.plans.frames import BIG_CANTONS, CURRENT_SQL, FEATURES_SQL, PANEL_SQL, SCORED_SQL, SPEC, current, features, panel, with_demo_score
from leadspark.registry import query
from leadspark.sources.tables import COMPANIES_SQL, companies

def _day(c):
    return iso_date(F.col(c)).alias(c)


@query(
    "src_table",
    "WITH " + COMPANIES_SQL + """
SELECT company_id, company_name, CAST(founding_year AS BIGINT) AS founding_year, postal_code, canton, city, legal_form,
  legal_code, industry_code_02, industry_code_04, industry_code_06, industry_text_06, headcount, headcount_band,
  CAST(headcount_band_order AS BIGINT) AS headcount_band_order, revenue, revenue_band,
  CAST(revenue_band_order AS BIGINT) AS revenue_band_order, CAST(risk_class AS BIGINT) AS risk_class, size_class,
  stock_category, strftime(joined_at, '%Y-%m-%d') AS joined_at, strftime(left_at, '%Y-%m-%d') AS left_at,
  strftime(deleted_at, '%Y-%m-%d') AS deleted_at
FROM companies""",
)
def src_table(spark, sf):
    whole = ["founding_year", "headcount_band_order", "revenue_band_order", "risk_class"]
    days = ["joined_at", "left_at", "deleted_at"]
    df = companies(spark, sf).drop("industry_text_02", "industry_text_04")
    return df.select(*[F.col(c).cast("long").alias(c) if c in whole else _day(c) if c in days else F.col(c) for c in df.columns])


PANEL_OUT = """company_id, company_name, canton, legal_form, postal_code, industry_code_06, headcount, revenue, size_class,
  strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, strftime(joined_at, '%Y-%m-%d') AS joined_at"""


def _panel_out(df):
    return df.select(
        "company_id", "company_name", "canton", "legal_form", "postal_code", "industry_code_06", "headcount", "revenue",
        "size_class", _day("snapshot_date"), _day("joined_at"),
    )


@query("src_modeling", "WITH " + PANEL_SQL + f"SELECT {PANEL_OUT}, CAST(target AS BIGINT) AS target FROM panel")
def src_modeling(spark, sf):
    df = panel(spark, sf)
    return df.select(
        "company_id", "company_name", "canton", "legal_form", "postal_code", "industry_code_06", "headcount", "revenue",
        "size_class", _day("snapshot_date"), _day("joined_at"), F.col("target").cast("long").alias("target"),
    )


@query("src_current", "WITH " + CURRENT_SQL + f"SELECT {PANEL_OUT} FROM prospects")
def src_current(spark, sf):
    return _panel_out(current(spark, sf))


NO_ALIVE_SQL = """
  FROM companies c CROSS JOIN snapshots s
  WHERE s.snapshot_date <= TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 12 MONTH
    AND (c.joined_at IS NULL OR c.joined_at >= s.snapshot_date)
    AND (c.founding_year IS NULL OR c.founding_year <= year(s.snapshot_date))"""


@query("src_count", "WITH " + PANEL_SQL + "SELECT count(*) AS n_rows" + NO_ALIVE_SQL)
def src_count(spark, sf):
    return P.modeling_panel(companies(spark, sf), SPEC, check_alive=False).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "src_random",
    "WITH " + PANEL_SQL + f""",
rows AS (
  SELECT c.company_id, s.snapshot_date, c.company_id * 1000000 + year(s.snapshot_date) * 100 + month(s.snapshot_date) AS row_key
  {NO_ALIVE_SQL}
),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY {hash32_sql('row_key')}, row_key) AS r, count(*) OVER () AS n FROM rows
)
SELECT row_key, company_id FROM ordered WHERE r <= greatest(2000, CAST(ceil(0.02 * n) AS BIGINT))""",
)
def src_random(spark, sf):
    df = P.modeling_panel(companies(spark, sf), SPEC, check_alive=False)
    n = df.count()
    return random_rows(df.select("row_key", "company_id"), F.col("row_key"), max(2000, -(-n * 2 // 100)))


@query("src_cache", "WITH " + PANEL_SQL + "SELECT row_key, company_id, CAST(target AS BIGINT) AS target, 12 AS horizon_months FROM panel")
def src_cache(spark, sf):
    from leadspark.session import scratch_path
    from leadspark.sources.cache import read_cache, write_cache

    path = scratch_path(spark, "cache")
    write_cache(panel(spark, sf), path, SPEC.horizon_months, "companies")
    frozen, meta = read_cache(spark, path)
    return frozen.select("row_key", "company_id", F.col("target").cast("long").alias("target"), F.lit(meta["horizon_months"]).alias("horizon_months"))


# ---- predicates -------------------------------------------------------------------------------

CROSS_SQL = "WITH " + PANEL_SQL + "SELECT strftime(s.snapshot_date, '%Y-%m-%d') AS snapshot_date, count(*) AS n FROM companies c CROSS JOIN snapshots s WHERE {} GROUP BY s.snapshot_date"


def _per_snapshot(spark, sf, condition):
    df = P.with_snapshots(companies(spark, sf), SPEC).where(condition)
    return df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")).select(_day("snapshot_date"), "n")



@query("flt_label_window", CROSS_SQL.format("s.snapshot_date <= TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 24 MONTH"))
def flt_label_window(spark, sf):
    longer = P.PanelSpec(SPEC.as_of, SPEC.offsets, 24)
    return _per_snapshot(spark, sf, P.label_window_complete(F.col("snapshot_date"), longer))


@query("flt_riskset", CROSS_SQL.format("c.joined_at IS NULL OR c.joined_at >= s.snapshot_date"))
def flt_riskset(spark, sf):
    return _per_snapshot(spark, sf, P.at_risk(F.col("joined_at"), F.col("snapshot_date")))


@query("flt_exists", CROSS_SQL.format("c.founding_year IS NULL OR c.founding_year <= year(s.snapshot_date)"))
def flt_exists(spark, sf):
    return _per_snapshot(spark, sf, P.exists_at(F.col("founding_year"), F.col("snapshot_date")))


@query(
    "flt_alive",
    CROSS_SQL.format("c.deleted_at IS NULL OR c.deleted_at = DATE '1888-12-31' OR c.deleted_at > s.snapshot_date"),
)
def flt_alive(spark, sf):
    return _per_snapshot(spark, sf, P.alive_at(F.col("deleted_at"), F.col("snapshot_date")))


@query("flt_current", "WITH " + CURRENT_SQL + "SELECT canton, count(*) AS n FROM prospects GROUP BY canton")
def flt_current(spark, sf):
    return current(spark, sf).groupBy("canton").agg(F.count(F.lit(1)).alias("n"))


@query(
    "prj_label",
    "WITH " + PANEL_SQL + """SELECT c.company_id, strftime(s.snapshot_date, '%Y-%m-%d') AS snapshot_date,
  CAST(CASE WHEN c.joined_at IS NOT NULL AND c.joined_at >= s.snapshot_date
       AND c.joined_at < s.snapshot_date + INTERVAL 12 MONTH THEN 1 ELSE 0 END AS BIGINT) AS target
FROM companies c CROSS JOIN snapshots s""",
)
def prj_label(spark, sf):
    target = P.label(F.col("joined_at"), F.col("snapshot_date"), SPEC.horizon_months)
    return P.with_snapshots(companies(spark, sf), SPEC).select("company_id", _day("snapshot_date"), target.cast("long").alias("target"))


@query(
    "prj_dropcols",
    "WITH " + PANEL_SQL + """SELECT CAST(founding_year AS BIGINT) AS founding_year, postal_code, canton, city, legal_form, legal_code,
  industry_code_02, industry_code_04, industry_code_06, headcount, CAST(headcount_band_order AS BIGINT) AS headcount_band_order,
  revenue, CAST(revenue_band_order AS BIGINT) AS revenue_band_order, CAST(risk_class AS BIGINT) AS risk_class, size_class,
  stock_category FROM panel""",
)
def prj_dropcols(spark, sf):
    kept = S.feature_columns(panel(spark, sf)).drop("row_key")
    return kept.select(*[F.col(c).cast("long").alias(c) if t == "int" else F.col(c) for c, t in kept.dtypes])


@query(
    "flt_dates_in",
    "WITH " + PANEL_SQL + """, d AS (SELECT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date DESC) AS r
  FROM (SELECT DISTINCT snapshot_date FROM panel))
SELECT row_key, company_id FROM panel WHERE snapshot_date IN (SELECT snapshot_date FROM d WHERE r <= 2)""",
)
def flt_dates_in(spark, sf):
    df = panel(spark, sf)
    return on_dates(df, split_dates(df)[-2:]).select("row_key", "company_id")


@query(
    "flt_positive_segments",
    "WITH " + PANEL_SQL + """SELECT row_key, canton, size_class,
  CASE WHEN size_class IN ('GROSS', 'SEHR GROSS', 'MITTEL') THEN 1 ELSE 0 END AS is_large,
  CASE WHEN coalesce(canton IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4'), false) THEN 0 ELSE 1 END AS is_outside
FROM panel WHERE target = 1 AND (size_class IN ('GROSS', 'SEHR GROSS', 'MITTEL')
  OR NOT coalesce(canton IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4'), false))""",
)
def flt_positive_segments(spark, sf):
    from leadspark.operators.sampling import LARGE_SIZES

    large = F.col("size_class").isin(*LARGE_SIZES)
    outside = ~F.coalesce(F.col("canton").isin(*BIG_CANTONS), F.lit(False))
    rows = panel(spark, sf).where((F.col("target") == 1) & (large | outside))
    return rows.select("row_key", "canton", "size_class", large.cast("int").alias("is_large"), outside.cast("int").alias("is_outside"))


@query("flt_finite", "WITH " + PANEL_SQL + "SELECT row_key, headcount FROM panel WHERE headcount IS NOT NULL AND headcount <> 0")
def flt_finite(spark, sf):
    """Scores made infinite by a division by zero, and missing ones, are left out."""
    x = F.col("headcount")
    risky = F.when(x == 0, F.lit(float("inf"))).otherwise(x)
    return panel(spark, sf).where(X.is_finite(risky)).select("row_key", "headcount")


@query(
    "prj_value_map",
    "WITH " + PANEL_SQL + """SELECT CASE WHEN canton IN ('NATION_0', 'NATION_1', 'NATION_2') THEN canton ELSE 'OTHER' END AS canton_group,
  CASE WHEN legal_form IN ('BUILDING', 'MACHINERY') THEN legal_form ELSE 'OTHER' END AS legal_group, count(*) AS n
FROM panel GROUP BY 1, 2""",
)
def prj_value_map(spark, sf):
    return (
        panel(spark, sf)
        .groupBy(
            X.grouped_value(F.col("canton"), BIG_CANTONS[:3]).alias("canton_group"),
            X.grouped_value(F.col("legal_form"), ("BUILDING", "MACHINERY")).alias("legal_group"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("prj_cols_select_stage", "WITH " + FEATURES_SQL + "SELECT row_key, headcount, revenue, CAST(company_age_years AS BIGINT) AS company_age_years FROM feat")
def prj_cols_select_stage(spark, sf):
    stage1 = ["headcount", "revenue", "company_age_years", "column_of_another_source"]
    df = S.available_columns(features(spark, sf), stage1, keep=("row_key",))
    return df.withColumn("company_age_years", F.col("company_age_years").cast("long"))


@query(
    "prj_types_str",
    "WITH " + FEATURES_SQL + """SELECT row_key, coalesce(postal_code, 'missing') AS postal_code,
  coalesce(industry_code_06, 'missing') AS industry_code_06, coalesce(CAST(risk_class AS VARCHAR), 'missing') AS risk_class FROM feat""",
)
def prj_types_str(spark, sf):
    cols = ["postal_code", "industry_code_06", "risk_class"]
    return S.as_category_text(features(spark, sf).select("row_key", *cols), cols)


@query("prj_float32", "WITH " + PANEL_SQL + "SELECT row_key, CAST(headcount AS FLOAT) AS headcount, CAST(revenue AS FLOAT) AS revenue FROM panel")
def prj_float32(spark, sf):
    return S.as_float32(panel(spark, sf).select("row_key", "headcount", "revenue"), ["headcount", "revenue"])


@query(
    "cte_chain",
    "WITH " + PANEL_SQL + """SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, count(*) AS n_rows,
  CAST(sum(target) AS BIGINT) AS positives, round(avg(target), 6) AS conversion_rate FROM panel GROUP BY snapshot_date""",
)
def cte_chain(spark, sf):
    """Conversion rate of at-risk companies per snapshot: the smallest end-to-end query."""
    return (
        panel(spark, sf)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col("target").cast("long")).alias("positives"),
            F.round(F.avg("target"), 6).alias("conversion_rate"),
        )
        .withColumn("snapshot_date", iso_date(F.col("snapshot_date")))
    )


# ---- joins ------------------------------------------------------------------------------------


@query(
    "join_cross_snapshots",
    "WITH " + PANEL_SQL + """SELECT c.company_id, strftime(s.snapshot_date, '%Y-%m-%d') AS snapshot_date
FROM companies c CROSS JOIN snapshots s WHERE (c.joined_at IS NULL OR c.joined_at >= s.snapshot_date)
  AND (c.founding_year IS NULL OR c.founding_year <= year(s.snapshot_date))
  AND (c.deleted_at IS NULL OR c.deleted_at = DATE '1888-12-31' OR c.deleted_at > s.snapshot_date)""",
)
def join_cross_snapshots(spark, sf):
    s = F.col("snapshot_date")
    keep = P.at_risk(F.col("joined_at"), s) & P.exists_at(F.col("founding_year"), s) & P.alive_at(F.col("deleted_at"), s)
    return P.with_snapshots(companies(spark, sf), SPEC).where(keep).select("company_id", _day("snapshot_date"))


@query("join_cross_today", "WITH " + CURRENT_SQL + "SELECT company_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, row_key FROM prospects")
def join_cross_today(spark, sf):
    return current(spark, sf).select("company_id", _day("snapshot_date"), "row_key")


@query(
    "join_anti_index",
    "WITH " + PANEL_SQL + "SELECT row_key FROM panel WHERE NOT (target = 1 AND size_class IN ('GROSS', 'SEHR GROSS', 'MITTEL'))",
)
def join_anti_index(spark, sf):
    from leadspark.operators.sampling import LARGE_SIZES

    df = panel(spark, sf).select("row_key", "target", "size_class")
    preserved = df.where((F.col("target") == 1) & F.col("size_class").isin(*LARGE_SIZES)).select("row_key")
    return df.join(preserved, "row_key", "left_anti").select("row_key")


@query(
    "join_positional",
    "WITH " + SCORED_SQL + "SELECT s.row_key, s.score, p.canton, CAST(p.target AS BIGINT) AS target FROM scored s JOIN panel p ON s.row_key = p.row_key",
)
def join_positional(spark, sf):
    """Features beside the base frame: columns are added in place, so no order is relied on."""
    return with_demo_score(panel(spark, sf)).select("row_key", "score", "canton", F.col("target").cast("long").alias("target"))


# ---- set operations ---------------------------------------------------------------------------


@query(
    "set_union_all",
    "WITH " + PANEL_SQL + """, d AS (SELECT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date DESC) AS r
  FROM (SELECT DISTINCT snapshot_date FROM panel))
SELECT p.row_key, CASE WHEN d.r = 2 THEN p.canton END AS canton FROM panel p JOIN d ON p.snapshot_date = d.snapshot_date WHERE d.r >= 2""",
)
def set_union_all(spark, sf):
    """Training plus validation rows; a column only one side has is null on the other."""
    from leadspark.operators.splits import split_by_dates

    train, val, _ = split_by_dates(panel(spark, sf))
    return train.select("row_key").unionByName(val.select("row_key", "canton"), allowMissingColumns=True)


@query(
    "set_except_rows",
    "WITH " + PANEL_SQL + """SELECT row_key, canton FROM panel WHERE row_key NOT IN
  (SELECT row_key FROM panel WHERE target = 1 AND canton NOT IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4'))""",
)
def set_except_rows(spark, sf):
    df = panel(spark, sf).select("row_key", "canton", "target")
    gone = df.where((F.col("target") == 1) & ~F.col("canton").isin(*BIG_CANTONS)).select("row_key")
    return df.join(gone, "row_key", "left_anti").select("row_key", "canton")


@query(
    "set_values",
    "WITH " + PANEL_SQL + """, v(n) AS (VALUES (36), (30), (24), (18), (12))
SELECT v.n AS months_back, strftime(TIMESTAMP '1998-12-01 00:00:00' - to_months(v.n), '%Y-%m-%d') AS snapshot_date, count(p.row_key) AS n_rows
FROM v LEFT JOIN panel p ON p.snapshot_date = TIMESTAMP '1998-12-01 00:00:00' - to_months(v.n) GROUP BY v.n""",
)
def set_values(spark, sf):
    offsets = spark.createDataFrame([(n,) for n in SPEC.offsets], "months_back int")
    dated = offsets.withColumn("snapshot_date", P.ts_literal(SPEC.as_of) - F.make_ym_interval(F.lit(0), F.col("months_back")))
    counts = panel(spark, sf).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return dated.join(counts, "snapshot_date", "left").fillna(0, ["n_rows"]).select("months_back", _day("snapshot_date"), "n_rows")


@query("fn_add_months", """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 HOUR - INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS month_back,
  strftime(o_orderdate + INTERVAL 10 HOUR + INTERVAL 12 MONTH, '%Y-%m-%d %H:%M:%S') AS year_on FROM orders""")
def fn_add_months(spark, sf):
    ts = F.col("o_orderdate") + F.expr("INTERVAL 10 HOURS")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.date_format(add_months(ts, -1), fmt).alias("month_back"), F.date_format(add_months(ts, 12), fmt).alias("year_on")
    )
