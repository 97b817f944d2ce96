"""Metrics and curves on the scored panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.operators import metrics as M
from leadspark.plans.frames import SCORED_SQL, scored
from leadspark.plans.q_ranking import DECILE, RANKED
from leadspark.registry import query

K = 1000
BETA = 2.0

CURVE_SQL = (
    "WITH "
    + SCORED_SQL
    + """,
g AS (SELECT score, count(*) AS n, sum(target) AS pos FROM scored GROUP BY score),
tot AS (SELECT CAST(sum(target) AS DOUBLE) AS p, CAST(count(*) - sum(target) AS DOUBLE) AS q FROM scored),
cum AS (
  SELECT score, n, pos, CAST(sum(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS above,
    CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS tp, p, q FROM g, tot
),
c AS (SELECT *, tp / above AS prec, tp / p AS rec, above - tp AS fp FROM cum)
"""
)


def _r(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("met_precision_k", RANKED + f"SELECT round(avg(target), 6) AS precision_at_k FROM ranked WHERE rank <= {K}")
def met_precision_k(spark, sf):
    return _r(M.at_k(scored(spark, sf), K).select("precision_at_k"), "precision_at_k")


@query("met_recall_k", RANKED + f"SELECT round(sum(CASE WHEN rank <= {K} THEN target END) / CAST(sum(target) AS DOUBLE), 6) AS recall_at_k FROM ranked")
def met_recall_k(spark, sf):
    return _r(M.at_k(scored(spark, sf), K).select("recall_at_k"), "recall_at_k")


@query("met_lift_k", RANKED + f"SELECT round(avg(CASE WHEN rank <= {K} THEN target END) / avg(target), 6) AS lift_at_k FROM ranked")
def met_lift_k(spark, sf):
    return _r(M.at_k(scored(spark, sf), K).select("lift_at_k"), "lift_at_k")


@query("met_pr_curve", CURVE_SQL + "SELECT score AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall FROM c UNION ALL SELECT NULL, 1.0, 0.0")
def met_pr_curve(spark, sf):
    return _r(M.pr_curve(scored(spark, sf)), "precision", "recall")


@query("met_ap", CURVE_SQL + "SELECT round(sum(pos / p * prec), 6) AS average_precision FROM c")
def met_ap(spark, sf):
    return _r(M.average_precision(scored(spark, sf)), "average_precision")


@query("met_roc", CURVE_SQL + "SELECT score AS threshold, round(fp / q, 6) AS fpr, round(rec, 6) AS tpr FROM c UNION ALL SELECT NULL, 0.0, 0.0")
def met_roc(spark, sf):
    return _r(M.roc_curve(scored(spark, sf)), "fpr", "tpr")


@query("met_auc", CURVE_SQL + "SELECT round(sum(pos * (q - fp + (n - pos) / 2.0)) / max(p * q), 6) AS auc FROM c")
def met_auc(spark, sf):
    return _r(M.auc(scored(spark, sf)), "auc")


@query("met_youden", CURVE_SQL + "SELECT score AS threshold, round(rec - fp / q, 6) AS youden_j FROM c ORDER BY rec - fp / q DESC, score DESC LIMIT 1")
def met_youden(spark, sf):
    return _r(M.youden_threshold(scored(spark, sf)), "youden_j")


@query("met_fbeta_opt", CURVE_SQL + "SELECT score AS threshold, round(f, 6) AS f_beta FROM (SELECT score, 5.0::DOUBLE * (prec * rec) / (4.0::DOUBLE * prec + rec + 1e-12::DOUBLE) AS f FROM c) ORDER BY f DESC, score LIMIT 1")
def met_fbeta_opt(spark, sf):
    return _r(M.best_fbeta(scored(spark, sf), BETA), "f_beta")


@query("met_recall_threshold", CURVE_SQL + "SELECT score AS threshold, round(rec, 6) AS recall, round(prec, 6) AS precision FROM c WHERE rec >= 0.95 ORDER BY score DESC LIMIT 1")
def met_recall_threshold(spark, sf):
    return _r(M.recall_threshold(scored(spark, sf), 0.95), "recall", "precision")


@query(
    "met_at_threshold",
    "WITH " + SCORED_SQL + """, k AS (SELECT count(*) FILTER (WHERE target = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE target = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (WHERE target = 1 AND score < 0.5) AS fn, count(*) AS n FROM scored),
pr AS (SELECT *, tp / CAST(greatest(tp + fp, 1) AS DOUBLE) AS prec, tp / CAST(greatest(tp + fn, 1) AS DOUBLE) AS rec FROM k)
SELECT CAST(0.5 AS DOUBLE) AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall, round(5 * prec * rec / greatest(4 * prec + rec, 1e-12), 6) AS f_beta,
  n AS support, tp + fn AS positives, tp + fp AS predicted_positives FROM pr""",
)
def met_at_threshold(spark, sf):
    return _r(M.at_threshold(scored(spark, sf), 0.5, BETA), "precision", "recall", "f_beta")


@query(
    "met_confusion",
    "WITH " + SCORED_SQL + """SELECT count(*) FILTER (WHERE target = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE target = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (WHERE target = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE target = 1 AND score >= 0.5) AS tp FROM scored""",
)
def met_confusion(spark, sf):
    return M.confusion(scored(spark, sf), 0.5)


@query(
    "met_brier",
    "WITH " + SCORED_SQL + """SELECT round(avg((score - target) * (score - target)), 6) AS brier, round(avg((score - 1) * (score - 1)) FILTER (WHERE target = 1), 6) AS brier_pos,
  round(avg(score * score) FILTER (WHERE target = 0), 6) AS brier_neg FROM scored""",
)
def met_brier(spark, sf):
    return _r(M.brier(scored(spark, sf)), "brier", "brier_pos", "brier_neg")


@query(
    "met_ece_k",
    RANKED + f""", b AS (SELECT least(CAST(floor(score * 10) AS BIGINT), 9) AS bin, count(*) AS n, avg(score) AS p, avg(target) AS y FROM ranked WHERE rank <= {K} GROUP BY 1)
SELECT round(sum(n * abs(p - y)) / sum(n), 6) AS ece FROM b""",
)
def met_ece_k(spark, sf):
    return _r(M.ece_at_k(scored(spark, sf), K), "ece")


EDGES = ", ".join(f"quantile_cont(score, {i / 10}) AS e{i}" for i in range(1, 10))
BIN = " + ".join(f"CASE WHEN score > e{i} THEN 1 ELSE 0 END" for i in range(1, 10))


@query(
    "met_calibration_curve",
    "WITH " + SCORED_SQL + f""", e AS (SELECT {EDGES} FROM scored)
SELECT CAST({BIN} AS BIGINT) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(target), 6) AS positive_share FROM scored, e GROUP BY 1""",
)
def met_calibration_curve(spark, sf):
    return _r(M.calibration_curve(scored(spark, sf)), "mean_score", "positive_share")


GAINS_SQL = RANKED + f""", d AS (SELECT CAST({DECILE} AS BIGINT) AS decile, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives FROM ranked GROUP BY 1)"""


@query(
    "agg_gains",
    GAINS_SQL + """SELECT decile, n, positives, round(positives / CAST(greatest(n, 1) AS DOUBLE), 6) AS rate,
  round((positives / CAST(greatest(n, 1) AS DOUBLE)) / greatest(sum(positives) OVER () / CAST(sum(n) OVER () AS DOUBLE), 1e-9), 6) AS lift FROM d""",
)
def agg_gains(spark, sf):
    return _r(M.gains_table(scored(spark, sf)), "rate", "lift")


@query(
    "agg_cumgains",
    GAINS_SQL + """SELECT decile, n, positives, CAST(sum(positives) OVER w AS BIGINT) AS cum_positives, round(sum(n) OVER w / CAST(sum(n) OVER () AS DOUBLE), 6) AS cum_pct_of_population,
  round(sum(positives) OVER w / CAST(greatest(sum(positives) OVER (), 1) AS DOUBLE), 6) AS cum_pct_of_positives,
  round((positives / CAST(n AS DOUBLE)) / nullif(sum(positives) OVER () / CAST(sum(n) OVER () AS DOUBLE), 0), 6) AS lift
FROM d WINDOW w AS (ORDER BY decile ROWS UNBOUNDED PRECEDING)""",
)
def agg_cumgains(spark, sf):
    return _r(M.cumulative_gains(scored(spark, sf)), "cum_pct_of_population", "cum_pct_of_positives", "lift")


@query("met_gains", GAINS_SQL + "SELECT decile, n, positives, CAST(sum(positives) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_positives FROM d")
def met_gains(spark, sf):
    return M.cumulative_gains(scored(spark, sf)).select("decile", "n", "positives", "cum_positives")


def _at_sql(split: str, t: str, prefix: str) -> str:
    """Columns of one split at one threshold."""
    hit, tp = f"count(*) FILTER (WHERE score >= {t})", f"count(*) FILTER (WHERE score >= {t} AND target = 1)"
    prec, rec = f"{tp} / CAST(greatest({hit}, 1) AS DOUBLE)", f"{tp} / CAST(greatest(sum(target), 1) AS DOUBLE)"
    return f"""round(any_value({t}), 6) AS {split}_{prefix}_threshold, round({prec}, 6) AS {split}_{prefix}_precision, round({rec}, 6) AS {split}_{prefix}_recall,
  round(5 * ({prec}) * ({rec}) / greatest(4 * ({prec}) + {rec}, 1e-12), 6) AS {split}_{prefix}_f_beta, count(*) AS {split}_{prefix}_support,
  CAST(sum(target) AS BIGINT) AS {split}_{prefix}_positives, {hit} AS {split}_{prefix}_predicted_positives"""


def _split_sql(s: str) -> str:
    """Tables of one split: its curve, its k best rows, and its one row of metrics."""
    return f"""{s}_g AS (SELECT score, count(*) AS n, CAST(sum(target) AS DOUBLE) AS pos FROM {s} GROUP BY score),
{s}_c AS (SELECT score, pos, sum(pos) OVER w / sum(n) OVER w AS prec, sum(pos) OVER w / sum(pos) OVER () AS rec, pos / sum(pos) OVER () AS step FROM {s}_g
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
{s}_k AS (SELECT * FROM {s} ORDER BY score DESC, row_key LIMIT {K}),
{s}_b AS (SELECT count(*) AS n, abs(avg(score) - avg(target)) AS gap FROM {s}_k GROUP BY least(floor(score * 10), 9))"""


def _block_sql(s: str) -> str:
    e = "(score - target) * (score - target)"
    return f"""{s}_m AS (SELECT (SELECT round(sum(step * prec), 6) FROM {s}_c) AS {s}_ap, (SELECT round(avg(target), 6) FROM {s}_k) AS {s}_precision_at_k,
  {_at_sql(s, 't_f', 'fbeta_metrics')}, {_at_sql(s, 't_k', 'topk_metrics')},
  round(avg({e}), 6) AS {s}_brier, round(avg({e}) FILTER (WHERE target = 1), 6) AS {s}_brier_pos, round(avg({e}) FILTER (WHERE target = 0), 6) AS {s}_brier_neg,
  (SELECT round(sum(n * gap) / sum(n), 6) FROM {s}_b) AS {s}_ece_at_k FROM {s}, t)"""


REPORT_SQL = (
    "WITH " + SCORED_SQL + f""",
dates AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date DESC) AS r FROM (SELECT DISTINCT snapshot_date FROM scored)),
validation AS (SELECT s.* FROM scored s JOIN dates USING (snapshot_date) WHERE r = 2),
test AS (SELECT s.* FROM scored s JOIN dates USING (snapshot_date) WHERE r = 1),
{_split_sql('validation')}, {_split_sql('test')},
t AS (SELECT (SELECT score FROM validation_c ORDER BY 5.0::DOUBLE * (prec * rec) / (4.0::DOUBLE * prec + rec + 1e-12::DOUBLE) DESC, score LIMIT 1) AS t_f, (SELECT min(score) FROM validation_k) AS t_k),
{_block_sql('validation')}, {_block_sql('test')}
SELECT 'none' AS calibration_method, CAST({BETA} AS DOUBLE) AS fbeta_beta, round(t_f, 6) AS fbeta_threshold, round(t_k, 6) AS top_k_threshold, CAST({K} AS BIGINT) AS k, validation_m.*, test_m.*
FROM t, validation_m, test_m"""
)


def _flat(report):
    """The nested report as one flat row, numbers rounded."""

    def leaves(schema, path, name):
        for f in schema.fields:
            at, label = f"{path}{f.name}", f"{name}{f.name}"
            if hasattr(f.dataType, "fields"):
                yield from leaves(f.dataType, f"{at}.", f"{label}_")
            else:
                yield (F.round(at, 6) if f.dataType.typeName() == "double" else F.col(at)).alias(label)

    return report.select(*leaves(report.schema, "", ""))


def _report(spark, sf):
    from leadspark.operators.splits import split_by_dates

    _, val, test = split_by_dates(scored(spark, sf))
    return M.threshold_report(val, test, K, BETA, "none")


@query("met_report", REPORT_SQL)
def met_report(spark, sf):
    """Thresholds from the validation split, metrics of both splits."""
    return _flat(_report(spark, sf))


@query("snk_report", REPORT_SQL)
def snk_report(spark, sf):
    """The nested report as a JSON document, written and read back."""
    from leadspark.operators.sinks import write_report
    from leadspark.session import scratch_path

    path, report = scratch_path(spark, "report"), _report(spark, sf)
    write_report(report, path)
    return _flat(spark.read.schema(report.schema).json(path))
