"""Scalar functions and the two feature builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.functions import features as X
from leadspark.functions.dates import iso_date, month_start
from leadspark.plans.frames import FEATURES_SQL, PANEL_SQL, SCORED_SQL, features, panel, scored
from leadspark.registry import query
from leadspark.sources.tables import REGISTER_SQL, companies, COMPANIES_SQL, read_table, register_events


def _long(c):
    return F.col(c).cast("long").alias(c)


@query("fn_year_month_quarter", """SELECT event_id, year(ts) AS y, month(ts) AS m, quarter(ts) AS q FROM events
UNION ALL SELECT -o_orderkey, year(o_orderdate), month(o_orderdate), quarter(o_orderdate) FROM orders""")
def fn_year_month_quarter(spark, sf):
    def parts(df, key, ts):
        return df.select(key.alias("event_id"), F.year(ts).cast("long").alias("y"), F.month(ts).cast("long").alias("m"), F.quarter(ts).cast("long").alias("q"))

    events, orders = read_table(spark, sf, "events"), read_table(spark, sf, "orders")
    return parts(events, F.col("event_id"), "ts").unionByName(parts(orders, -F.col("o_orderkey"), "o_orderdate"))


@query("fn_trunc_month", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS n FROM orders GROUP BY 1")
def fn_trunc_month(spark, sf):
    month = iso_date(month_start(F.col("o_orderdate"))).alias("month")
    return read_table(spark, sf, "orders").groupBy(month).agg(F.count(F.lit(1)).alias("n"))


@query("fn_date_fmt", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def fn_date_fmt(spark, sf):
    return read_table(spark, sf, "events").select("event_id", iso_date(F.col("ts")).alias("day"))


FEAT = "WITH " + FEATURES_SQL


@query("fn_age", FEAT + "SELECT row_key, CAST(company_age_years AS BIGINT) AS company_age_years FROM feat")
def fn_age(spark, sf):
    age = X.company_age(F.col("founding_year"), F.col("snapshot_date"))
    return panel(spark, sf).select("row_key", age.cast("long").alias("company_age_years"))


@query("fn_log1p", FEAT + "SELECT row_key, round(company_age_log, 6) AS company_age_log, round(headcount_log1p, 6) AS headcount_log1p, round(revenue_log1p, 6) AS revenue_log1p FROM feat")
def fn_log1p(spark, sf):
    df = features(spark, sf)
    return df.select("row_key", *[F.round(c, 6).alias(c) for c in ("company_age_log", "headcount_log1p", "revenue_log1p")])


@query("fn_age_bucket", FEAT + "SELECT company_age_bucket, count(*) AS n FROM feat GROUP BY 1")
def fn_age_bucket(spark, sf):
    bucket = X.age_bucket(X.company_age(F.col("founding_year"), F.col("snapshot_date")))
    return panel(spark, sf).groupBy(bucket.alias("company_age_bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_cyclic_month", """SELECT event_id, round(sin(2 * pi() * month(ts) / 12), 6) AS month_sin, round(cos(2 * pi() * month(ts) / 12), 6) AS month_cos
FROM (SELECT o_orderkey AS event_id, o_orderdate AS ts FROM orders)""")
def fn_cyclic_month(spark, sf):
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.round(X.month_sin(d), 6).alias("month_sin"), F.round(X.month_cos(d), 6).alias("month_cos")
    )


@query("fn_eoq", "SELECT month(o_orderdate) AS m, CASE WHEN month(o_orderdate) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end, count(*) AS n FROM orders GROUP BY 1, 2")
def fn_eoq(spark, sf):
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").groupBy(F.month(d).alias("m"), X.is_quarter_end(d).alias("is_quarter_end")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_summer", "SELECT month(o_orderdate) AS m, CASE WHEN month(o_orderdate) IN (7, 8) THEN 1 ELSE 0 END AS is_summer, count(*) AS n FROM orders GROUP BY 1, 2")
def fn_summer(spark, sf):
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").groupBy(F.month(d).alias("m"), X.is_summer(d).alias("is_summer")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_missing_flag", FEAT + "SELECT row_key, is_missing_headcount, is_missing_revenue FROM feat")
def fn_missing_flag(spark, sf):
    return panel(spark, sf).select(
        "row_key", X.missing_flag(F.col("headcount")).alias("is_missing_headcount"), X.missing_flag(F.col("revenue")).alias("is_missing_revenue")
    )


@query("fn_plz_prefix", FEAT + "SELECT row_key, plz2, plz3 FROM feat")
def fn_plz_prefix(spark, sf):
    p = F.col("postal_code")
    return panel(spark, sf).select("row_key", X.postal_prefix(p, 2).alias("plz2"), X.postal_prefix(p, 3).alias("plz3"))


@query("fn_noga", FEAT + "SELECT row_key, noga_section, noga_division, noga_group FROM feat")
def fn_noga(spark, sf):
    c = F.col("industry_code_06")
    return panel(spark, sf).select(
        "row_key", X.industry_section(c).alias("noga_section"), X.industry_digits(c, 2).alias("noga_division"), X.industry_digits(c, 3).alias("noga_group")
    )


@query("fn_cross_feature", FEAT + "SELECT canton_noga_section, count(*) AS n FROM feat GROUP BY 1")
def fn_cross_feature(spark, sf):
    cross = X.cross_feature(F.col("canton"), X.industry_section(F.col("industry_code_06")))
    return panel(spark, sf).groupBy(cross.alias("canton_noga_section")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_norm_case", "WITH " + REGISTER_SQL + "SELECT kanton, shab_id, count(*) AS n FROM shab GROUP BY 1, 2")
def fn_norm_case(spark, sf):
    df = register_events(spark, sf)
    return df.groupBy(F.upper(F.trim("kanton")).alias("kanton"), F.upper("shab_id").alias("shab_id")).agg(F.sum("publications").alias("n"))


@query("fn_to_number", "WITH " + COMPANIES_SQL + "SELECT company_id, TRY_CAST(postal_code AS DOUBLE) AS postal_number FROM companies")
def fn_to_number(spark, sf):
    return companies(spark, sf).select("company_id", X.to_number(F.col("postal_code")).alias("postal_number"))


@query("fn_floor_decade", "WITH " + COMPANIES_SQL + "SELECT company_id, CAST(floor(founding_year / 10) * 10 AS BIGINT) AS decade FROM companies")
def fn_floor_decade(spark, sf):
    return companies(spark, sf).select("company_id", X.decade(F.col("founding_year")).cast("long").alias("decade"))


@query("fn_sigmoid", "WITH " + SCORED_SQL + "SELECT row_key, round(1 / (1 + exp(-(score * 8 - 4))), 6) AS p FROM scored")
def fn_sigmoid(spark, sf):
    return scored(spark, sf).select("row_key", F.round(X.sigmoid(F.col("score") * 8 - 4), 6).alias("p"))


@query("fn_clip01", "WITH " + SCORED_SQL + "SELECT row_key, round(least(greatest(score * 1.5 - 0.25, 0), 1), 6) AS p FROM scored")
def fn_clip01(spark, sf):
    return scored(spark, sf).select("row_key", F.round(X.clip01(F.col("score") * 1.5 - 0.25), 6).alias("p"))


@query("fn_minmax", "WITH " + SCORED_SQL + """, b AS (SELECT min(score) AS lo, max(score) AS hi FROM scored)
SELECT row_key, round((score - lo) / nullif(hi - lo, 0), 6) AS p FROM scored, b""")
def fn_minmax(spark, sf):
    from leadspark.operators.models import minmax_score

    return minmax_score(scored(spark, sf), "score", "p").select("row_key", F.round("p", 6).alias("p"))


@query("fn_sqrt_l2", """SELECT vec_id, round(sqrt(greatest(sum((CAST(e AS DOUBLE) - (i - 1) / 64.0::DOUBLE) * (CAST(e AS DOUBLE) - (i - 1) / 64.0::DOUBLE)), 0)), 6) AS dist
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY vec_id""")
def fn_sqrt_l2(spark, sf):
    origin = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i.cast("double") / 64)
    dist = X.safe_sqrt(X.squared_distance(F.col("embedding"), origin))
    return read_table(spark, sf, "embeddings").select("vec_id", F.round(dist, 6).alias("dist"))


@query("fn_concat_key", "WITH " + PANEL_SQL + """SELECT CAST(target AS VARCHAR) || '|' || canton || '|' || coalesce(headcount_band, 'nan') AS key_text, count(*) AS n
FROM panel GROUP BY 1""")
def fn_concat_key(spark, sf):
    key = X.concat_key(F.col("target"), F.col("canton"), F.col("headcount_band"))
    return panel(spark, sf).groupBy(key.alias("key_text")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "enc_temporal",
    FEAT + """SELECT row_key, CAST(company_age_years AS BIGINT) AS company_age_years, round(company_age_log, 6) AS company_age_log,
  company_age_bucket, round(month_sin, 6) AS month_sin, round(month_cos, 6) AS month_cos, is_quarter_end, is_summer,
  CAST(quarter AS BIGINT) AS quarter FROM feat""",
)
def enc_temporal(spark, sf):
    from leadspark.operators.panel import add_temporal_features

    df = add_temporal_features(panel(spark, sf))
    return df.select(
        "row_key", _long("company_age_years"), F.round("company_age_log", 6).alias("company_age_log"), "company_age_bucket",
        F.round("month_sin", 6).alias("month_sin"), F.round("month_cos", 6).alias("month_cos"), "is_quarter_end", "is_summer", _long("quarter"),
    )


@query(
    "enc_features",
    FEAT + """SELECT row_key, is_missing_headcount, is_missing_revenue, plz2, plz3, noga_section, noga_division, noga_group,
  canton_noga_section, round(headcount_log1p, 6) AS headcount_log1p, round(revenue_log1p, 6) AS revenue_log1p FROM feat""",
)
def enc_features(spark, sf):
    from leadspark.operators.panel import add_company_features

    df = add_company_features(panel(spark, sf))
    return df.select(
        "row_key", "is_missing_headcount", "is_missing_revenue", "plz2", "plz3", "noga_section", "noga_division", "noga_group",
        "canton_noga_section", F.round("headcount_log1p", 6).alias("headcount_log1p"), F.round("revenue_log1p", 6).alias("revenue_log1p"),
    )
