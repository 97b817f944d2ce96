"""Fitted encoders on the feature frame."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadspark.functions.hashing import hash32_sql
from leadspark.operators import encoders as E
from leadspark.operators.splits import split_by_dates
from leadspark.plans.frames import FEATURES_SQL, features
from leadspark.registry import query
from leadspark.schema import HIGH_CARD, NUMERIC, RoleSchema, autodetect_roles
from leadspark.session import cut

FEAT = "WITH " + FEATURES_SQL
MEDIANS = ["headcount", "revenue", "headcount_band_order", "revenue_band_order"]
ONEHOT = ["canton", "legal_form", "size_class", "stock_category", "legal_code", "company_age_bucket", "industry_code_02"]


@query("enc_median", FEAT + "SELECT row_key, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM feat)) AS {c}" for c in MEDIANS) + " FROM feat")
def enc_median(spark, sf):
    df = features(spark, sf).select("row_key", *MEDIANS)
    return E.impute(df, E.medians(df, MEDIANS))


@query("enc_const", FEAT + "SELECT row_key, coalesce(postal_code, 'missing') AS postal_code, coalesce(headcount_band, 'missing') AS headcount_band FROM feat")
def enc_const(spark, sf):
    cols = ["postal_code", "headcount_band"]
    return E.impute_constant(features(spark, sf).select("row_key", *cols), cols)


@query("enc_power")
def enc_power(spark, sf):
    df = features(spark, sf).select("row_key", *NUMERIC)
    filled = cut(E.impute(df, E.medians(df, list(NUMERIC))), spread=True)
    return E.power_transform(filled, E.fit_power(filled, list(NUMERIC)))


@query(
    "enc_power_fixed",
    FEAT + """, t AS (SELECT row_key, (sqrt(coalesce(headcount, 0) + 1) - 1) / 0.5 AS a, ln(1 + coalesce(revenue, 0)) AS b FROM feat)
SELECT row_key, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) AS headcount, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 6) AS revenue FROM t""",
)
def enc_power_fixed(spark, sf):
    df = E.impute(features(spark, sf).select("row_key", "headcount", "revenue"), {"headcount": 0.0, "revenue": 0.0})
    out = E.power_transform(df, {"headcount": 0.5, "revenue": 0.0})
    return out.select("row_key", F.round("headcount", 6).alias("headcount"), F.round("revenue", 6).alias("revenue"))


@query(
    "enc_standardize",
    FEAT + """, t AS (SELECT row_key, coalesce(headcount, 0) AS a, coalesce(revenue, 0) AS b FROM feat)
SELECT row_key, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) AS headcount, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 6) AS revenue FROM t""",
)
def enc_standardize(spark, sf):
    out, _ = E.standardize(features(spark, sf).select("row_key", "headcount", "revenue"), ["headcount", "revenue"])
    return out.select("row_key", F.round("headcount", 6).alias("headcount"), F.round("revenue", 6).alias("revenue"))


def _onehot_sql(c: str) -> str:
    return f"""{c}_n AS (SELECT coalesce({c}, 'missing') AS v, count(*) AS k, sum(count(*)) OVER () AS n FROM feat GROUP BY 1),
{c}_f AS (SELECT *, count(*) FILTER (WHERE k >= 0.01 * n) OVER () AS freq, count(*) OVER () AS total, row_number() OVER (ORDER BY k DESC, v DESC) AS r FROM {c}_n),
{c}_k AS (SELECT v FROM {c}_f WHERE k >= 0.01 * n AND (freq + CASE WHEN total > freq THEN 1 ELSE 0 END <= 20 OR r <= 19))"""


@query(
    "enc_onehot_rare",
    FEAT + "," + ",\n".join(_onehot_sql(c) for c in ONEHOT) + "\nSELECT row_key, "
    + ", ".join(f"CASE WHEN coalesce({c}, 'missing') IN (SELECT v FROM {c}_k) THEN coalesce({c}, 'missing') ELSE 'infrequent' END AS {c}" for c in ONEHOT)
    + " FROM feat",
)
def enc_onehot_rare(spark, sf):
    """The category each row sets to one."""
    df = features(spark, sf).select("row_key", *ONEHOT)
    specs, counts = E.fit_onehot(df, ONEHOT)
    flagged = E.with_known_flags(df, specs, counts)
    return flagged.select("row_key", *[E.onehot_bucket(s).alias(s.column) for s in specs])


def _te_sql(rule: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", value, round({rule}, 6) AS encoding FROM (SELECT coalesce({c}, 'missing') AS value, CAST(count(*) AS DOUBLE) AS n, CAST(sum(target) AS DOUBLE) / count(*) AS m FROM feat GROUP BY 1), t"
        for c in HIGH_CARD
    ]
    return FEAT + ", t AS (SELECT avg(target) AS prior, avg(target) * (1 - avg(target)) AS pv FROM feat) " + " UNION ALL ".join(parts)


SHRUNK = "coalesce((n * pv / nullif(n * pv + m * (1 - m), 0)) * m + (1 - n * pv / nullif(n * pv + m * (1 - m), 0)) * prior, prior)"
FIXED = "CASE WHEN n = 1 THEN prior ELSE prior * (1 - 1 / (1 + exp(-(n - 20) / 10))) + m / (1 + exp(-(n - 20) / 10)) END"


def _table(spark, sf, kind):
    table, _ = E.fit_target_encoding(features(spark, sf), list(HIGH_CARD), kind=kind)
    return table.withColumn("encoding", F.round("encoding", 6))


@query("enc_target", _te_sql(SHRUNK))
def enc_target(spark, sf):
    return _table(spark, sf, "auto")


@query("enc_target_fixed", _te_sql(FIXED))
def enc_target_fixed(spark, sf):
    return _table(spark, sf, "fixed")


@query(
    "join_code_lookup",
    FEAT + """, d AS (SELECT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date DESC) AS r FROM (SELECT DISTINCT snapshot_date FROM feat)),
codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(postal_code, 'missing') AS v FROM feat JOIN d USING (snapshot_date) WHERE r > 2))
SELECT row_key, CAST(coalesce(code, -1) AS INTEGER) AS postal_index FROM feat JOIN d USING (snapshot_date) LEFT JOIN codes ON v = coalesce(postal_code, 'missing') WHERE r = 1""",
)
def join_code_lookup(spark, sf):
    """Codes fitted on the training dates, looked up for the test date."""
    train, _, test = split_by_dates(features(spark, sf))
    table = E.fit_label_index(train, "postal_code")
    return E.apply_label_index(test, "postal_code", table, "postal_index").select("row_key", "postal_index")


@query("enc_label_index", FEAT + "SELECT v AS value, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(industry_code_06, 'missing') AS v FROM feat)")
def enc_label_index(spark, sf):
    return E.fit_label_index(features(spark, sf), "industry_code_06")


def _cv_sql(c: str) -> str:
    return f"""{c}_s AS (SELECT {c} AS v, fold, CAST(count(*) AS DOUBLE) AS n, CAST(sum(target) AS DOUBLE) AS pos FROM folded GROUP BY 1, 2),
{c}_o AS (SELECT v, fold, sum(n) OVER (PARTITION BY v) - n AS n, sum(pos) OVER (PARTITION BY v) - pos AS pos FROM {c}_s),
{c}_m AS (SELECT o.v, o.fold, o.n, o.pos / nullif(o.n, 0) AS m, g.prior, g.prior * (1 - g.prior) AS pv FROM {c}_o o JOIN g ON o.fold = g.fold),
{c}_e AS (SELECT v, fold, CASE WHEN n > 0 THEN {SHRUNK} ELSE prior END AS e FROM {c}_m)"""


@query(
    "enc_target_cv",
    FEAT + f""", folded AS (SELECT row_key, target, noga_division, plz3, canton_noga_section, (row_number() OVER (PARTITION BY target ORDER BY {hash32_sql('row_key')}, row_key) - 1) % 5 AS fold FROM feat),
gs AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, CAST(sum(target) AS DOUBLE) AS pos FROM folded GROUP BY 1),
g AS (SELECT fold, (sum(pos) OVER () - pos) / (sum(n) OVER () - n) AS prior FROM gs),
{_cv_sql('noga_division')}, {_cv_sql('plz3')}, {_cv_sql('canton_noga_section')}
SELECT f.row_key, round(a.e, 6) AS noga_division_te, round(b.e, 6) AS plz3_te, round(c.e, 6) AS canton_noga_section_te FROM folded f
JOIN noga_division_e a ON a.v = f.noga_division AND a.fold = f.fold JOIN plz3_e b ON b.v = f.plz3 AND b.fold = f.fold
JOIN canton_noga_section_e c ON c.v = f.canton_noga_section AND c.fold = f.fold""",
)
def enc_target_cv(spark, sf):
    cols = ["noga_division", "plz3", "canton_noga_section"]
    df = E.cross_fitted_encoding(features(spark, sf).select("row_key", "target", *cols), cols)
    return df.select("row_key", *[F.round(f"{c}_te", 6).alias(f"{c}_te") for c in cols])


MASTER_TEXT = [
    "company_name", "postal_code", "canton", "city", "legal_form", "legal_code", "industry_code_02", "industry_code_04", "industry_code_06",
    "industry_text_02", "industry_text_04", "industry_text_06", "headcount_band", "revenue_band", "size_class", "stock_category",
]
MADE_TEXT = ["company_age_bucket", "plz2", "plz3", "noga_division", "noga_group", "noga_section", "canton_noga_section"]
MASTER_NUMBERS = ["company_id", "founding_year", "headcount", "headcount_band_order", "revenue", "revenue_band_order", "risk_class"]
MADE_NUMBERS = [
    "company_age_years", "company_age_log", "month_sin", "month_cos", "is_quarter_end", "is_summer", "quarter", "is_missing_headcount",
    "headcount_log1p", "is_missing_revenue", "revenue_log1p",
]


def _kind_sql(cols: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS kind, round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS null_share FROM feat" for c in cols
    )


@query("enc_autodetect", FEAT + _kind_sql(MASTER_TEXT + MADE_TEXT, "categorical") + " UNION ALL " + _kind_sql(MASTER_NUMBERS + MADE_NUMBERS, "numeric"))
def enc_autodetect(spark, sf):
    df = features(spark, sf)
    found = autodetect_roles(df, exclude=("row_key", "target"))
    kinds = {c: kind for kind, cols in zip(("categorical", "numeric"), found) for c in cols}
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in kinds])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.round(c, 6).alias("null_share")) for c, k in kinds.items()]
    return shares.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def _role_sql() -> str:
    r = RoleSchema()
    roles = {c: role for role in ("numeric", "ordinal", "low_card", "high_card") for c in getattr(r, role)}
    other = ["joined_at", "left_at", "deleted_at", "snapshot_date", "target", "row_key"]
    cols = MASTER_TEXT + MADE_TEXT + MASTER_NUMBERS + MADE_NUMBERS + other
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{roles.get(c, 'drop')}' AS role, count({c}) AS n_values FROM feat" for c in cols)


@query("prj_roles", FEAT + _role_sql())
def prj_roles(spark, sf):
    """Every column with the treatment its role gives it, and how many values it holds."""
    r = RoleSchema()
    df = features(spark, sf)
    r.check(df)
    roles = {c: role for role in ("numeric", "ordinal", "low_card", "high_card") for c in getattr(r, role)}
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(roles.get(c, "drop")).alias("role"), F.col(c).alias("n_values")) for c in df.columns]
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


@query("enc_pipeline")
def enc_pipeline(spark, sf):
    """Training rows through the whole preprocessor: key, label and vector."""
    train, _, _ = split_by_dates(features(spark, sf))
    _, out = E.LeadPreprocessor().fit_transform(train)
    return out.select("row_key", "target", vector_to_array("features").alias("features"))


@query("enc_validate")
def enc_validate(spark, sf):
    train, _, _ = split_by_dates(features(spark, sf))
    info = E.validate_preprocessor(train)
    rows = [(i, n) for i, n in enumerate(info["feature_names"])]
    names = spark.createDataFrame(rows, "position int, feature string")
    return names.withColumns({"n_rows": F.lit(info["transformed_shape"][0]), "n_features": F.lit(info["n_features"])})


