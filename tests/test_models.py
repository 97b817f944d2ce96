import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leadspark.operators import calibration as C
from leadspark.operators import metrics as M
from leadspark.operators import models as L
from leadspark.operators.scorers import TopKEvaluator, lift_at_k_scorer, precision_at_k_scorer, recall_at_k_scorer
from leadspark.operators.splits import stratified_folds, time_folds
from leadspark.session import cut

LOGIT = dict(kind="logit", C=1.0, maxIter=50)
TREE = dict(kind="tree", maxDepth=3, minInstancesPerNode=5)


def logit(d):
    return L.fit_model(d, **LOGIT)


def tree(d):
    return L.fit_model(d, **TREE)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 1.0).astype(int)
    pdf = pd.DataFrame({"row_key": np.arange(n, dtype="int64"), "target": y, "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2]})
    return cut(spark.createDataFrame(pdf).withColumn("features", array_to_vector(F.array("x0", "x1", "x2"))))


def check_scores(out, n):
    pdf = out.select("row_key", "target", "p").toPandas()
    assert len(pdf) == n and not pdf["row_key"].duplicated().any() and pdf["p"].between(0, 1).all()
    return pdf


def auc(out):
    return M.auc(out.select("target", "p"), score="p").first()[0]


@pytest.mark.parametrize("params", [LOGIT, TREE, dict(kind="gbt", maxIter=3, maxDepth=3), dict(kind="forest", numTrees=5), dict(kind="rank", maxIter=3, maxDepth=3)])
def test_single_models_save_and_load(data, params, tmp_path):
    m = L.fit_model(data, **params)
    a = check_scores(m.score(data), 600)
    assert auc(m.score(data)) > 0.85
    m.save(str(tmp_path / "m"))
    b = check_scores(L.FittedModel.load(str(tmp_path / "m")).score(data), 600)
    pd.testing.assert_frame_equal(a.sort_values("row_key").reset_index(drop=True), b.sort_values("row_key").reset_index(drop=True))
    assert set(m.predict(m.score(data)).select("prediction").distinct().toPandas()["prediction"]) <= {0, 1}


def test_one_class_gives_a_constant(data, tmp_path):
    m = L.fit_model(data.where("target = 0"), **LOGIT)
    assert {r["p"] for r in m.score(data).select("p").distinct().collect()} == {0.0}
    m.save(str(tmp_path / "m"))
    assert L.FittedModel.load(str(tmp_path / "m")).constant == 0
    assert {r["p"] for r in L.fit_model(data.where("target = 1"), **LOGIT).score(data).select("p").distinct().collect()} == {1.0}


def test_class_weights(data):
    row = L.class_weight_table(data).first()
    n, pos = 600, data.where("target = 1").count()
    assert row["scale_pos_weight"] == pytest.approx((n - pos) / pos)
    assert row["weight_1"] == pytest.approx(n / (2 * pos))
    assert L.class_weight_table(data.where("target = 0")).first()["weight_1"] is None


def test_out_of_fold_scores_every_row_once(data):
    check_scores(L.out_of_fold(data, logit, folds=3, parallelism=3), 600)


def test_bagging_and_stacking(data):
    bag = L.fit_bagging(data, lambda b: L.fit_model(b, balanced=False, **TREE), n_bags=3)
    check_scores(bag.score(data), 600)
    bases = {"a": logit, "b": tree}
    stacked = L.fit_stacking(data, bases, folds=2, calibrate="isotonic", parallelism=2)
    check_scores(stacked.score(data), 600)
    assert auc(stacked.score(data)) > 0.85
    with pytest.raises(ValueError):
        L.fit_stacking(data, {"a": logit})


def test_two_stage(data):
    m = L.fit_two_stage(data, logit, tree, target_recall=0.9, folds=3)
    out = cut(m.passes_filter(m.predict(m.score(data))))
    check_scores(out, 600)
    d = m.diagnostics()
    assert d["stage1_recall"] >= 0.9 and 0 < d["stage2_class_balance"] < 1
    assert 0 < out.where("passed").count() < 600
    one = m.stage1.score(data, "p1")
    blocked = out.where("not passed").join(one.select("row_key", "p1"), "row_key")
    assert blocked.where("abs(p - p1) > 1e-12").count() == 0


def test_two_stage_with_columns(data):
    df = L.stage_vectors(data, ["x0", "absent"], ["x0", "x1", "x2"])
    m = L.two_stage_with_columns(df, LOGIT, TREE, folds=2, calibrate=False)
    check_scores(m.score(df), 600)


def test_isotonic_is_monotone(data):
    scored = cut(logit(data).score(data))
    cal = C.fit_calibrator(scored, "isotonic")
    out = cal.apply(scored, "p", "q").select("p", "q").orderBy("p").toPandas()
    assert (out["q"].diff().fillna(0) >= -1e-12).all() and out["q"].between(0, 1).all()
    assert out["q"].mean() == pytest.approx(data.agg(F.avg("target")).first()[0], abs=0.02)


@pytest.mark.parametrize("method", ["sigmoid", "beta"])
def test_logistic_calibration_improves_brier(data, method):
    scored = cut(logit(data).score(data))  # balanced weights overstate the probability
    cal = C.fit_calibrator(scored, method)
    before = M.brier(scored, score="p").first()["brier"]
    after = M.brier(cal.apply(scored, "p", "q"), score="q").first()["brier"]
    assert after < before
    if method == "beta":
        assert min(cal.coefficients) >= 0


def test_beta_needs_ten_scores(data):
    with pytest.raises(ValueError):
        C.fit_beta(logit(data).score(data).limit(9))


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_fold_calibration(data, method):
    folded = cut(stratified_folds(data, 3))
    check_scores(L.fit_calibrated(folded, logit, L.class_fold_conditions(3), method).score(data), 600)


def test_beta_calibrated_model(data):
    placed = data.withColumn("position", F.col("row_key"))
    m = L.fit_beta_calibrated(placed, logit, L.time_fold_conditions(time_folds(600, 3, 20)))
    check_scores(m.score(data), 600)


def test_random_search(data):
    placed = data.withColumn("position", F.col("row_key"))
    found = L.random_search(placed, time_folds(600, 2, 20), {"maxDepth": [1, 3]}, n_iter=5, kind="tree", parallelism=2)
    assert len(found.trials) == 4 and found.best_params in ({"maxDepth": 1}, {"maxDepth": 3})
    assert 0 < found.best_score <= 1
    check_scores(found.model.score(data), 600)


def test_parameter_tiers():
    assert L.choose_parameters({"a": 1}, lambda: None, lambda: "s", force_search=False) == ("known", {"a": 1})
    assert L.choose_parameters(None, lambda: ("m", {}, {}), lambda: "s", force_search=False)[0] == "saved"
    assert L.choose_parameters(None, lambda: (None, None, None), lambda: "s", force_search=False)[0] == "search"
    assert L.choose_parameters({"a": 1}, lambda: None, lambda: "s")[0] == "search"


def test_drawn_parameters_differ():
    drawn = L.draw_params({"a": [1, 2, 3], "b": [4, 5]}, 6)
    assert len({tuple(sorted(d.items())) for d in drawn}) == 6
    assert L.draw_params(L.SEARCH_GRID, 10) == L.draw_params(L.SEARCH_GRID, 10)


def test_importances(spark, data):
    names = ["x0", "x1", "x2"]
    for params in (LOGIT, TREE):
        assert L.native_importance(L.fit_model(data, **params), names).first()["feature"] == "x0"
    m = logit(data)
    df = data.drop("features")
    perm = L.permutation_importance(df, lambda d: m.score(d.withColumn("features", array_to_vector(F.array(*names)))), names, repeats=2)
    assert perm.first()["feature"] == "x0" and perm.first()["importance"] > 0.2
    imp = spark.createDataFrame([("canton=ZH", 1.0), ("canton=BE", 2.0), ("emb__12", 0.5), ("emb__3", 0.5), ("age", 3.0)], "feature string, importance double")
    assert {r["source"]: r["importance"] for r in L.importance_by_source(imp).collect()} == {"canton": 3.0, "emb": 1.0, "age": 3.0}


def test_scorers(spark):
    df = spark.createDataFrame([(i, int(i < 2), 1 - i / 10) for i in range(10)], "row_key long, target int, s double")
    assert precision_at_k_scorer(2, score="s").evaluate(df) == 1 and recall_at_k_scorer(1, score="s").evaluate(df) == 0.5
    assert lift_at_k_scorer(2, score="s").evaluate(df) == pytest.approx(5)
    assert TopKEvaluator("average_precision", score="s").evaluate(df) == 1 and TopKEvaluator().isLargerBetter()


def test_score_extraction(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 4.0)], "k long, s double")
    vec = array_to_vector(F.array(-F.col("s"), F.col("s")))
    got = L.extract_score(df.withColumn("rawPrediction", vec)).orderBy("k").collect()
    assert [(r["y_score"], r["y_prob"]) for r in got] == [(0.0, 0.0), (4.0, 1.0)]
    flat = L.extract_score(df.where("k = 1").withColumn("rawPrediction", vec)).first()
    assert flat["y_prob"] is None
    assert L.extract_score(df.withColumn("prediction", F.lit(1))).first()["y_score"] == 1.0
