"""Models, ensembles, calibration and importances on the panel.

Model settings here are smaller than the library defaults so that a check run
stays short; they do not depend on the data.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leadspark.operators import models as L
from leadspark.operators.calibration import fit_isotonic
from leadspark.operators.encoders import LeadPreprocessor, LeadPreprocessorModel
from leadspark.operators.scorers import TopKEvaluator, lift_at_k_scorer, precision_at_k_scorer, recall_at_k_scorer
from leadspark.operators.splits import on_dates, split_by_dates, time_folds, with_position
from leadspark.plans.frames import PANEL_SQL, SCORED_SQL, features, panel, scored
from leadspark.plans.q_metrics import CURVE_SQL
from leadspark.plans.q_sampling import FOLD_GAP
from leadspark.registry import query
from leadspark.session import cut, scratch_path

INPUTS = ["headcount_log1p", "revenue_log1p", "company_age_log", "is_missing_headcount", "is_missing_revenue", "risk_class", "revenue_band_order", "headcount_band_order"]
SMALL_GBT = dict(kind="gbt", maxIter=4, maxDepth=3)
SMALL_TREE = dict(kind="tree", maxDepth=6, minInstancesPerNode=20)


def _frames(spark, sf):
    """Stored training, validation and test rows with a numeric feature vector."""
    df = features(spark, sf).select(
        "row_key", "company_id", "snapshot_date", "target", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in INPUTS]
    )
    vec = cut(VectorAssembler(inputCols=INPUTS, outputCol="features").transform(df), spread=True)
    return split_by_dates(vec)


def _scored(model, df):
    return model.score(df, "p").select("row_key", "target", "p")


def _logit(d):
    return L.fit_model(d, **L.BACKENDS["filter_logit"])


def _gbt(d):
    return L.fit_model(d, **SMALL_GBT)


def _folds(df, n_splits):
    n = df.count()
    placed = cut(with_position(df))
    return placed, time_folds(n, n_splits, FOLD_GAP)


@query("mdl_gbt")
def mdl_gbt(spark, sf):
    """Whole preprocessor and class-weighted boosted trees, scored on the last snapshot."""
    train, _, test = split_by_dates(features(spark, sf))
    pre, fitted = LeadPreprocessor().fit_transform(train, keep=["row_key", "target"])
    model = L.fit_model(cut(fitted, spread=True), kind="gbt", maxIter=10, maxDepth=4)
    return _scored(model, pre.transform(pre.sources(test, ["row_key", "target"])))


@query("mdl_logit")
def mdl_logit(spark, sf):
    train, _, test = _frames(spark, sf)
    return _scored(_logit(train), test)


@query("mdl_forest")
def mdl_forest(spark, sf):
    train, _, test = _frames(spark, sf)
    return _scored(L.fit_model(train, kind="forest", numTrees=20, maxDepth=6), test)


@query("mdl_tree")
def mdl_tree(spark, sf):
    train, _, test = _frames(spark, sf)
    return _scored(L.fit_model(train, **SMALL_TREE), test)


@query("mdl_bagging")
def mdl_bagging(spark, sf):
    train, _, test = _frames(spark, sf)
    return _scored(L.fit_bagging(train, lambda b: L.fit_model(b, balanced=False, **SMALL_TREE), n_bags=3, parallelism=3), test)


@query("mdl_stacking")
def mdl_stacking(spark, sf):
    train, _, test = _frames(spark, sf)
    bases = L.stacking_bases(n_bags=2, boosted=dict(kind="gbt", maxIter=2, maxDepth=3), second=dict(kind="gbt", maxIter=2, maxDepth=2), tree=SMALL_TREE, pos_weight=10.0)
    return _scored(L.fit_stacking(train.select("row_key", "target", "features"), bases, folds=2, parallelism=2), test)


@query("mdl_oof")
def mdl_oof(spark, sf):
    train, _, _ = _frames(spark, sf)
    return L.out_of_fold(train, _logit, parallelism=3).select("row_key", "target", "p")


@query("mdl_two_stage")
def mdl_two_stage(spark, sf):
    train, _, test = _frames(spark, sf)
    model = L.fit_two_stage(train, _logit, _gbt, folds=3, parallelism=3)
    both = model.passes_filter(model.predict(model.score(test)))
    out = both.select("row_key", "target", "p", "prediction", "passed")
    return out.withColumns({k: F.lit(v) for k, v in model.diagnostics().items()})


@query("mdl_two_stage_cols")
def mdl_two_stage_cols(spark, sf):
    """A few columns for the filter, all for the ranking; names a frame lacks are skipped."""
    train, _, test = _frames(spark, sf)
    few = ["headcount_log1p", "revenue_log1p", "column_of_another_source"]
    first, second = (L.stage_vectors(d.drop("features"), few, INPUTS) for d in (train, test))
    model = L.two_stage_with_columns(first, stage2_kind=SMALL_GBT, folds=3, calibrate=False, parallelism=3)
    return _scored(model, second)


MERGE_SQL = "SELECT row_key, score AS p1, round(1 - score * 0.5, 6) AS p2, CASE WHEN score >= 0.4 THEN round(1 - score * 0.5, 6) ELSE score END AS p FROM scored"


@query("mdl_two_stage_merge", "WITH " + SCORED_SQL + MERGE_SQL)
def mdl_two_stage_merge(spark, sf):
    df = scored(spark, sf).select("row_key", F.col("score").alias("p1"), F.round(1 - F.col("score") * 0.5, 6).alias("p2"))
    return df.withColumn("p", L.merge_two_stage(F.col("p1"), F.col("p2"), 0.4))


@query("scr_extract", "WITH " + SCORED_SQL + """, s AS (SELECT row_key, score * 8 - 4 AS y_score FROM scored), b AS (SELECT min(y_score) AS lo, max(y_score) AS hi FROM s)
SELECT row_key, round(y_score, 6) AS y_score, round((y_score - lo) / nullif(hi - lo, 0), 6) AS y_prob FROM s, b""")
def scr_extract(spark, sf):
    """A model without probabilities: its raw score, and the same stretched to [0, 1]."""
    raw = F.col("score") * 8 - 4
    out = L.extract_score(scored(spark, sf).withColumn("rawPrediction", array_to_vector(F.array(-raw, raw))))
    return out.select("row_key", F.round("y_score", 6).alias("y_score"), F.round("y_prob", 6).alias("y_prob"))


@query(
    "scr_single_class",
    "WITH " + PANEL_SQL + """, k AS (SELECT canton, CASE WHEN min(target) = max(target) THEN min(target) END AS known FROM panel WHERE snapshot_date = (SELECT max(snapshot_date) FROM panel) GROUP BY canton)
SELECT canton, CAST(CASE WHEN known = 1 THEN 1.0 WHEN known = 0 THEN 0.0 END AS DOUBLE) AS p FROM k""",
)
def scr_single_class(spark, sf):
    """Cantons whose latest rows have one class get the constant probability of that class."""
    df = panel(spark, sf)
    last = df.agg(F.max("snapshot_date")).first()[0]
    known = on_dates(df, [last]).groupBy("canton").agg(F.min("target").alias("lo"), F.max("target").alias("hi"))
    p = F.when(F.col("lo") == F.col("hi"), L.single_class_probability(F.col("lo")))
    return known.select("canton", p.alias("p"))


@query("mdl_rank_scores")
def mdl_rank_scores(spark, sf):
    """Raw ranking score, its sigmoid and the class at 0.5."""
    train, _, test = _frames(spark, sf)
    model = L.fit_model(train, kind="rank", maxIter=4, maxDepth=3)
    return model.predict(model.score(test)).select("row_key", "target", "p", "prediction")


@query("mdl_search")
def mdl_search(spark, sf):
    """Trials of a random search over time folds, the chosen one marked."""
    train, val, _ = _frames(spark, sf)
    placed, folds = _folds(train.unionByName(val), 2)
    grid = {"maxDepth": [3, 4, 5], "minInstancesPerNode": [10, 20, 50]}
    found = L.random_search(placed, folds, grid, n_iter=3, kind="tree", parallelism=3)
    rows = [(t["candidate"], t["fold"], t["average_precision"], t["precision_at_k"]) for t in found.trials]
    trials = spark.createDataFrame(rows, "candidate int, fold int, average_precision double, precision_at_k double")
    return trials.withColumn("best_score", F.lit(found.best_score))


def _calibrated(spark, sf, method):
    train, val, test = _frames(spark, sf)
    placed, folds = _folds(train.unionByName(val), 3)
    parts = L.time_fold_conditions(folds)
    if method == "beta":
        return _scored(L.fit_beta_calibrated(placed, _logit, parts, parallelism=3), test)
    return _scored(L.fit_calibrated(placed, _logit, parts, method, parallelism=3), test)


@query("cal_isotonic")
def cal_isotonic(spark, sf):
    return _calibrated(spark, sf, "isotonic")


#: The fit by its max-min formula: the greatest over all starts of the least over all ends of the mean between them.
MAX_MIN_SQL = """, c AS (SELECT score AS s, count(*) AS n, sum(target) AS p FROM scored GROUP BY 1),
cum AS (SELECT s, sum(n) OVER w AS n, sum(p) OVER w AS p, sum(n) OVER w - n AS n0, sum(p) OVER w - p AS p0 FROM c WINDOW w AS (ORDER BY s)),
means AS (SELECT a.s AS a, b.s AS b, (b.p - a.p0) / CAST(b.n - a.n0 AS DOUBLE) AS m FROM cum a JOIN cum b ON a.s <= b.s),
least AS (SELECT a, b AS s, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM means),
fit AS (SELECT s, max(m) AS q FROM least GROUP BY s)
SELECT row_key, round(q, 6) AS p FROM scored JOIN fit ON scored.score = fit.s"""


@query("cal_isotonic_fit", "WITH " + SCORED_SQL + MAX_MIN_SQL)
def cal_isotonic_fit(spark, sf):
    """The demo score calibrated on all rows; its thousand values lie in some sixty buckets."""
    rows = cut(scored(spark, sf).select("row_key", "target", "score"))
    return fit_isotonic(rows, "score", rows_per_bucket=16).apply(rows, "score", "p").select("row_key", F.round("p", 6).alias("p"))


@query("cal_sigmoid")
def cal_sigmoid(spark, sf):
    return _calibrated(spark, sf, "sigmoid")


@query("cal_beta")
def cal_beta(spark, sf):
    return _calibrated(spark, sf, "beta")


@query(
    "met_scorers",
    CURVE_SQL + """, r AS (SELECT target, row_number() OVER (ORDER BY score DESC, row_key) AS r FROM scored)
SELECT 'precision_at_k' AS metric, round(avg(target) FILTER (WHERE r <= 200), 6) AS value FROM r
UNION ALL SELECT 'recall_at_k', round(sum(target) FILTER (WHERE r <= 200) / CAST(sum(target) AS DOUBLE), 6) FROM r
UNION ALL SELECT 'lift_at_k', round(avg(target) FILTER (WHERE r <= 200) / avg(target), 6) FROM r
UNION ALL SELECT 'average_precision', round(sum(pos / p * prec), 6) FROM c""",
)
def met_scorers(spark, sf):
    """Scorers bound to k = 200 on the demo score."""
    df = cut(scored(spark, sf))
    scorers = {
        "precision_at_k": precision_at_k_scorer(200, score="score"),
        "recall_at_k": recall_at_k_scorer(200, score="score"),
        "lift_at_k": lift_at_k_scorer(200, score="score"),
        "average_precision": TopKEvaluator("average_precision", score="score"),
    }
    return spark.createDataFrame([(n, round(s.evaluate(df), 6)) for n, s in scorers.items()], "metric string, value double")


@query("imp_feature_names")
def imp_feature_names(spark, sf):
    train, _, _ = split_by_dates(features(spark, sf))
    pre, fitted = LeadPreprocessor(power=False).fit_transform(train)
    names = L.feature_names(fitted)
    rows = [(i, n, s) for i, (n, (_, s)) in enumerate(zip(names, pre.feature_names))]
    return spark.createDataFrame(rows, "position int, feature string, source string")


@query("imp_native")
def imp_native(spark, sf):
    train, _, _ = _frames(spark, sf)
    return L.native_importance(_gbt(train), INPUTS)


@query("agg_importance_rollup")
def agg_importance_rollup(spark, sf):
    """Importances of the encoded features summed per source column."""
    train, _, _ = split_by_dates(features(spark, sf))
    pre, fitted = LeadPreprocessor(power=False).fit_transform(train)
    model = L.fit_model(cut(fitted.select("target", "features")), **SMALL_TREE)
    names = pre.feature_names
    sources = spark.createDataFrame(names, "feature string, source string")
    return L.importance_by_source(L.native_importance(model, [n for n, _ in names]), sources)


@query("imp_permutation")
def imp_permutation(spark, sf):
    train, _, test = _frames(spark, sf)
    model = _logit(train)
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="features")
    df = test.select("row_key", "target", *INPUTS)
    return L.permutation_importance(df, lambda d: model.score(assembler.transform(d)), INPUTS[:3], repeats=1)


@query("mdl_save")
def mdl_save(spark, sf):
    """Save a model with its metadata and list what was written."""
    from leadspark.operators.sinks import model_exists, save_model

    train, _, _ = _frames(spark, sf)
    params = dict(kind="tree", maxDepth=6)
    model = L.fit_model(train, **params)
    path = scratch_path(spark, "model")
    save_model(model.model, path, params, best_score=0.0, n_iter=1)
    meta = spark.read.json(f"{path}/meta")
    return meta.withColumn("complete", F.lit(model_exists(path))).select("spark_version", "n_iter", "best_score", "complete", "params")


@query("mdl_load")
def mdl_load(spark, sf):
    """Preprocessor and model saved, loaded back, and scoring the last snapshot."""
    train, _, test = split_by_dates(features(spark, sf))
    pre, fitted = LeadPreprocessor(power=False).fit_transform(train)
    model = L.fit_model(cut(fitted.select("target", "features")), **SMALL_TREE)
    path = scratch_path(spark, "model")
    pre.write().overwrite().save(f"{path}/preprocessor")
    model.save(f"{path}/classifier")
    loaded = L.FittedModel.load(f"{path}/classifier")
    return _scored(loaded, LeadPreprocessorModel.load(f"{path}/preprocessor").transform(test))
