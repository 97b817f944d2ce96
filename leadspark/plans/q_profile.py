"""Table profile of the current prospects."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date
from leadspark.operators import profile as P
from leadspark.operators import sampling, splits
from leadspark.operators.metrics import positives_share
from leadspark.plans.frames import CURRENT_SQL, MAJOR_CANTONS, MAJOR_FORMS, PANEL_SQL, current, panel
from leadspark.registry import query

NUMBERS = ["founding_year", "headcount", "headcount_band_order", "revenue", "revenue_band_order", "risk_class"]
TEXTS = ["canton", "legal_form", "size_class", "postal_code", "headcount_band"]
DATES = ["joined_at", "left_at", "deleted_at"]
ALL = [
    "company_id", "company_name", "founding_year", "postal_code", "canton", "legal_form", "industry_code_06", "headcount",
    "headcount_band", "revenue", "risk_class", "size_class", "joined_at", "left_at", "deleted_at",
]


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def union_sql(template: str, cols: list[str]) -> str:
    return "WITH " + CURRENT_SQL + " UNION ALL ".join(template.replace("@", c) for c in cols)


@query("agg_overview", "WITH " + CURRENT_SQL + "SELECT count(*) AS n_rows, 28 AS n_columns, 8 AS n_numeric, 16 AS n_string, 4 AS n_date FROM prospects")
def agg_overview(spark, sf):
    return P.overview(current(spark, sf))


MISSING_SQL = "SELECT '@' AS \"column\", count(*) - count(@) AS missing_count, round((count(*) - count(@)) * 100.0 / count(*), 6) AS missing_percentage FROM prospects"


@query("agg_missing", union_sql(MISSING_SQL, ALL))
def agg_missing(spark, sf):
    return _rounded(P.missing_table(current(spark, sf).select(*ALL)), "missing_percentage")


@query(
    "agg_describe",
    union_sql(
        """SELECT '@' AS "column", count(@) AS "count", round(avg(@), 6) AS mean, round(stddev_samp(@), 6) AS std, CAST(min(@) AS DOUBLE) AS min,
round(quantile_cont(@, 0.25), 6) AS p25, round(quantile_cont(@, 0.5), 6) AS p50, round(quantile_cont(@, 0.75), 6) AS p75, CAST(max(@) AS DOUBLE) AS max FROM prospects""",
        NUMBERS,
    ),
)
def agg_describe(spark, sf):
    return _rounded(P.describe_table(current(spark, sf), NUMBERS), "mean", "std", "p25", "p50", "p75")


@query(
    "agg_numextra",
    union_sql(
        """SELECT '@' AS "column", round(CAST(max(@) - min(@) AS DOUBLE), 6) AS range, count(DISTINCT @) AS distinct_values, count(*) FILTER (WHERE @ = 0) AS zeros,
round(count(*) FILTER (WHERE @ = 0) * 100.0 / count(*), 6) AS zero_pct FROM prospects""",
        NUMBERS,
    ),
)
def agg_numextra(spark, sf):
    return _rounded(P.numeric_extras(current(spark, sf), NUMBERS), "zero_pct", "range")


TOPCAT_SQL = """(SELECT '@' AS "column", value, n, rank, round(n * 100.0 / total, 6) AS pct FROM (
SELECT @ AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, @) AS rank, (SELECT count(*) FROM prospects) AS total
FROM prospects WHERE @ IS NOT NULL GROUP BY @) WHERE rank <= LIMIT_N)"""


@query("agg_topcat", union_sql(TOPCAT_SQL.replace("LIMIT_N", "20"), TEXTS))
def agg_topcat(spark, sf):
    return _rounded(P.top_categories(current(spark, sf), TEXTS, 20), "pct")


@query("snk_text", union_sql(TOPCAT_SQL.replace("LIMIT_N", "20"), ["canton", "size_class", "industry_code_02"]))
def snk_text(spark, sf):
    """The top-20 report as written to files and read back."""
    from leadspark.operators.sinks import read_category_report, write_category_report
    from leadspark.session import scratch_path

    path = scratch_path(spark, "categories")
    write_category_report(P.top_categories(current(spark, sf), ["canton", "size_class", "industry_code_02"], 20), path)
    return _rounded(read_category_report(spark, path), "pct")


@query(
    "agg_dates",
    union_sql(
        """SELECT '@' AS "column", count(@) AS "count", strftime(min(@), '%Y-%m-%d') AS first, strftime(max(@), '%Y-%m-%d') AS last,
CAST(date_diff('day', min(@), max(@)) AS BIGINT) AS span_days FROM prospects""",
        DATES,
    ),
)
def agg_dates(spark, sf):
    return P.date_table(current(spark, sf), DATES)


@query(
    "agg_decade",
    "WITH " + CURRENT_SQL + """SELECT CAST(floor(founding_year / 10) * 10 AS BIGINT) AS decade, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM prospects WHERE founding_year IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def agg_decade(spark, sf):
    return _rounded(P.decade_table(current(spark, sf), "founding_year"), "pct")


REGION_CASES = " ".join(
    f"WHEN TRY_CAST(postal_code AS INTEGER) >= {d * 1000} AND TRY_CAST(postal_code AS INTEGER) < {(d + 1) * 1000} THEN '{name}'"
    for d, name in P.POSTAL_REGIONS.items()
)


@query(
    "agg_region",
    "WITH " + CURRENT_SQL + f"""SELECT CASE WHEN TRY_CAST(postal_code AS INTEGER) IS NULL THEN 'Invalid/Other' {REGION_CASES} ELSE 'Other' END AS region,
count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM prospects WHERE postal_code IS NOT NULL GROUP BY 1""",
)
def agg_region(spark, sf):
    return _rounded(P.region_table(current(spark, sf), "postal_code"), "pct")


@query(
    "agg_postal",
    "WITH " + CURRENT_SQL + """SELECT count(TRY_CAST(postal_code AS DOUBLE)) AS numeric_codes, round(count(TRY_CAST(postal_code AS DOUBLE)) * 100.0 / count(*), 6) AS numeric_pct,
min(TRY_CAST(postal_code AS DOUBLE)) AS lowest, max(TRY_CAST(postal_code AS DOUBLE)) AS highest, count(DISTINCT postal_code) AS distinct_codes FROM prospects""",
)
def agg_postal(spark, sf):
    return _rounded(P.postal_numbers(current(spark, sf), "postal_code"), "numeric_pct")


@query("agg_industry", union_sql(TOPCAT_SQL.replace("LIMIT_N", "10"), ["industry_text_02", "industry_text_04", "industry_text_06"]))
def agg_industry(spark, sf):
    df = current(spark, sf)
    return _rounded(P.top_categories(df, P.industry_columns(df), 10), "pct")


@query("agg_posrate", "WITH " + PANEL_SQL + "SELECT count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS positives, round(avg(target), 6) AS rate FROM panel")
def agg_posrate(spark, sf):
    return _rounded(positives_share(panel(spark, sf)), "rate")


@query(
    "agg_classweight",
    "WITH " + PANEL_SQL + """, c AS (SELECT CAST(sum(target) AS DOUBLE) AS pos, CAST(count(*) - sum(target) AS DOUBLE) AS neg FROM panel)
SELECT round(neg / greatest(pos, 1), 6) AS scale_pos_weight, round((pos + neg) / (2 * neg), 6) AS weight_0, round((pos + neg) / (2 * pos), 6) AS weight_1 FROM c""",
)
def agg_classweight(spark, sf):
    from leadspark.operators.models import class_weight_table

    return _rounded(class_weight_table(panel(spark, sf)), "scale_pos_weight", "weight_0", "weight_1")


@query(
    "agg_distinct_dates",
    "WITH " + PANEL_SQL + "SELECT DISTINCT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date FROM panel ORDER BY 1",
)
def agg_distinct_dates(spark, sf):
    return splits.distinct_dates(panel(spark, sf)).orderBy("snapshot_date").select(iso_date(F.col("snapshot_date")).alias("snapshot_date"))


GAP_SQL = "CAST(floor(greatest(100.0, least(2 * (CAST(count(*) AS DOUBLE) / greatest(count(DISTINCT date_trunc('month', snapshot_date)), 1)), 2000.0))) AS BIGINT)"


@query("agg_samples_per_month", "WITH " + PANEL_SQL + f"SELECT count(*) AS n_rows, count(DISTINCT date_trunc('month', snapshot_date)) AS n_months, {GAP_SQL} AS gap FROM panel")
def agg_samples_per_month(spark, sf):
    return splits.samples_per_month_gap(panel(spark, sf))


def group_sql(col: str, keep: tuple[str, ...]) -> str:
    names = ", ".join(f"'{k}'" for k in keep)
    return f"CASE WHEN {col} IN ({names}) THEN {col} ELSE 'OTHER' END"


STRATUM_SQL = (
    "CAST(target AS VARCHAR) || '|' || " + group_sql("canton", MAJOR_CANTONS) + " || '|' || size_class || '|' || CAST(year(snapshot_date) AS VARCHAR) || '|' || "
    + group_sql("legal_form", MAJOR_FORMS)
)


@query("agg_strata", "WITH " + PANEL_SQL + f"SELECT {STRATUM_SQL} AS stratum, count(*) AS size FROM panel GROUP BY 1")
def agg_strata(spark, sf):
    return sampling.strata_sizes(sampling.with_stratum(panel(spark, sf), "target", major_cantons=MAJOR_CANTONS, major_forms=MAJOR_FORMS))
