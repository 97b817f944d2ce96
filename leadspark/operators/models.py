"""Conversion models on ``pyspark.ml``: weighted classifiers, bagging, stacking, two stages, search.

Every fitted object has ``score(df)``, which adds the positive-class probability ``p``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.functions.features import sigmoid
from leadspark.operators import metrics as M
from leadspark.operators.sampling import balanced_bags
from leadspark.operators.splits import TimeFold, stratified_folds
from leadspark.session import cut

# Model settings by backend, and the search grid of boosted trees.
BACKENDS = {
    "hgb": dict(kind="gbt", maxIter=100, stepSize=0.1, maxDepth=5, minInstancesPerNode=20),
    "boosted_deep": dict(kind="gbt", maxIter=200, stepSize=0.05, maxDepth=6, minInstancesPerNode=1),
    "hgb_bagging": dict(kind="gbt", maxIter=200, stepSize=0.05, maxDepth=8, minInstancesPerNode=50),
    "two_stage_rank": dict(kind="gbt", maxIter=300, stepSize=0.05, maxDepth=8, minInstancesPerNode=20),
    "filter_logit": dict(kind="logit", C=0.1, maxIter=1000),
    "filter_forest": dict(kind="forest", numTrees=100, maxDepth=10),
    "filter_hgb": dict(kind="gbt", maxIter=100, stepSize=0.1, maxDepth=5),
    "logit": dict(kind="logit", C=1.0, maxIter=1000),
    "bag_tree": dict(kind="tree", maxDepth=10, minInstancesPerNode=20),
}
#: Grids of the backends that are searched; what they do not name stays as in BACKENDS.
SEARCH_GRID = {
    "stepSize": [round(float(10**e), 6) for e in np.linspace(-2.3, -0.7, 8)],
    "maxIter": [100, 200, 300],
    "maxDepth": [4, 5, 6],
    "minInstancesPerNode": [10, 20, 50],
}
BAGGING_GRID = {
    "n_bags": [20, 30, 40],
    "stepSize": [round(float(10**e), 6) for e in np.linspace(-2.0, -0.7, 4)],
    "maxIter": [200, 300],
    "maxDepth": [6, 8],
    "minInstancesPerNode": [20, 50],
}
SEARCH_GRIDS = {"hgb": SEARCH_GRID, "boosted_deep": SEARCH_GRID, "two_stage": SEARCH_GRID, "hgb_bagging": BAGGING_GRID}
#: Settings an earlier full search of the boosted trees ended with.
KNOWN_BEST = {"hgb": {"minInstancesPerNode": 50, "maxDepth": 6, "maxIter": 300, "stepSize": 0.06963974029624322}}
N_BAGS = 30
SEARCH_ITERATIONS = 10
TARGET_RECALL = 0.95
STAGE1_FOLDS = 5
CALIBRATE_ABOVE = 20


# ---- weights and scores -------------------------------------------------------------------------


def class_weight_table(df: DataFrame, target: str = "target") -> DataFrame:
    """neg/pos ratio and balanced weights n / (2 * class size)."""
    counts = df.agg(
        F.coalesce(F.sum((F.col(target) == 1).cast("double")), F.lit(0.0)).alias("pos"),
        F.coalesce(F.sum((F.col(target) == 0).cast("double")), F.lit(0.0)).alias("neg"),
    )
    n = F.col("pos") + F.col("neg")
    return counts.select(
        (F.col("neg") / F.greatest("pos", F.lit(1.0))).alias("scale_pos_weight"),
        (n / F.nullif(2 * F.col("neg"), F.lit(0.0))).alias("weight_0"),
        (n / F.nullif(2 * F.col("pos"), F.lit(0.0))).alias("weight_1"),
    )


def minmax_score(df: DataFrame, score: str, out: str) -> DataFrame:
    """Score stretched to [0, 1]; null where all scores are equal."""
    edges = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    lo, hi = F.lit(edges["lo"]).cast("double"), F.lit(edges["hi"]).cast("double")
    return df.withColumn(out, (F.col(score) - lo) / F.nullif(hi - lo, F.lit(0.0)))


def extract_score(df: DataFrame) -> DataFrame:
    """Add ``y_score`` and ``y_prob`` from what a model put out.

    A probability serves as both; else the raw score, stretched to [0, 1] for
    ``y_prob``; else the predicted class as score and no probability.
    """
    if "probability" in df.columns:
        p = vector_to_array("probability")[1]
        return df.withColumns({"y_score": p, "y_prob": p})
    if "rawPrediction" in df.columns:
        return minmax_score(df.withColumn("y_score", vector_to_array("rawPrediction")[1]), "y_score", "y_prob")
    return df.withColumns({"y_score": F.col("prediction").cast("double"), "y_prob": F.lit(None).cast("double")})


def merge_two_stage(p1: Column, p2: Column, threshold: float | Column) -> Column:
    """Second-stage probability for rows that pass the first stage, else the first-stage one."""
    return F.when(p1 >= threshold, p2).otherwise(p1)


def single_class_probability(known: Column) -> Column:
    """Probability a model puts out when its training rows had one class only."""
    return F.when(known == 1, F.lit(1.0)).otherwise(F.lit(0.0))


# ---- single models ------------------------------------------------------------------------------


def _estimator(kind: str, features: str, target: str, weight: str | None, n: int, seed: int, **params):
    common = dict(featuresCol=features, labelCol=target)
    if weight:
        common["weightCol"] = weight
    if kind == "gbt":
        return C.GBTClassifier(seed=seed, **common, **params)
    if kind == "logit":
        strength = params.pop("C", None)
        reg = 1.0 / (strength * max(n, 1)) if strength else 0.0
        return C.LogisticRegression(regParam=reg, standardization=False, **common, **params)
    if kind == "forest":
        return C.RandomForestClassifier(seed=seed, **common, **params)
    if kind == "tree":
        return C.DecisionTreeClassifier(seed=seed, **common, **params)
    if kind == "rank":
        return R.GBTRegressor(seed=seed, **common, **params)
    raise ValueError(f"unknown model kind {kind!r}")


_LOADERS = {
    "gbt": C.GBTClassificationModel,
    "logit": C.LogisticRegressionModel,
    "forest": C.RandomForestClassificationModel,
    "tree": C.DecisionTreeClassificationModel,
    "rank": R.GBTRegressionModel,
}


@dataclass
class FittedModel:
    """A fitted model, or the one class its training rows had."""

    kind: str
    model: object | None
    constant: int | None = None

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        if self.model is None:
            return df.withColumn(out, single_class_probability(F.lit(self.constant)))
        model = self.model.copy().setPredictionCol("_m_class")
        if self.kind == "rank":
            return model.transform(df).withColumn(out, sigmoid(F.col("_m_class"))).drop("_m_class")
        model = model.setRawPredictionCol("_m_raw").setProbabilityCol("_m_prob")
        return model.transform(df).withColumn(out, vector_to_array("_m_prob")[1]).drop("_m_raw", "_m_prob", "_m_class")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.score(df, "_p").withColumn(out, (F.col("_p") >= 0.5).cast("int")).drop("_p")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        meta = json.dumps({"kind": self.kind, "constant": self.constant, "spark_version": spark.version})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/kind")
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/fitted")

    @staticmethod
    def load(path: str) -> "FittedModel":
        meta = json.loads(SparkSession.active().read.text(f"{path}/kind").first()[0])
        model = None if meta["constant"] is not None else _LOADERS[meta["kind"]].load(f"{path}/fitted")
        return FittedModel(meta["kind"], model, meta["constant"])


def fit_model(
    df: DataFrame,
    kind: str = "gbt",
    features: str = "features",
    target: str = "target",
    balanced: bool = True,
    pos_weight: float | None = None,
    seed: int = 42,
    **params,
) -> FittedModel:
    """Fit one model with balanced class weights, or with ``pos_weight`` on positives."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("pos")).first()
    n, pos = int(counts["n"]), int(counts["pos"] or 0)
    if pos in (0, n):
        return FittedModel(kind, None, int(pos > 0))
    data, weight = df.select(features, F.col(target).cast("double").alias(target)), None
    if kind != "rank" and (balanced or pos_weight is not None):
        w1, w0 = (pos_weight, 1.0) if pos_weight is not None else (n / (2 * pos), n / (2 * (n - pos)))
        data, weight = data.withColumn("weight", F.when(F.col(target) == 1, w1).otherwise(w0)), "weight"
    return FittedModel(kind, _estimator(kind, features, target, weight, n, seed, **params).fit(data))


@dataclass
class EncodedModel:
    """A model together with the preprocessor of its own training rows; scores raw rows."""

    preprocessor: object
    model: object

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        return self.model.score(self.preprocessor.transform(df), out).select(*df.columns, out)


def fit_backend(df: DataFrame, backend: str, **overrides) -> FittedModel:
    return fit_model(df, **{**BACKENDS[backend], **overrides})


Fit = Callable[[DataFrame], "FittedModel"]


def _in_threads(jobs: list[Callable], parallelism: int) -> list:
    """Run driver loops side by side; each fit is a distributed job of its own."""
    if parallelism <= 1:
        return [j() for j in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda j: j(), jobs)


def out_of_fold(df: DataFrame, fit: Fit, folds: int = STAGE1_FOLDS, target: str = "target", key: str = "row_key", seed: int = 42, parallelism: int = 1, out: str = "p") -> DataFrame:
    """Every row scored once, by a model that did not see it."""
    folded = cut(stratified_folds(df, folds, target, key, seed))
    models = _in_threads([lambda i=i: fit(folded.where(F.col("fold") != i)) for i in range(folds)], parallelism)
    result = None
    for i, m in enumerate(models):
        part = m.score(folded.where(F.col("fold") == i), out).drop("fold")
        result = part if result is None else result.unionByName(part)
    return result


# ---- calibration --------------------------------------------------------------------------------


@dataclass
class CalibratedModel:
    """Mean over folds of each fold's calibrated probability."""

    members: list

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        total: Column = F.lit(0.0)
        for i, (model, calibrator) in enumerate(self.members):
            df = calibrator.apply(model.score(df, f"_raw{i}"), f"_raw{i}", f"_cal{i}")
            total = total + F.col(f"_cal{i}")
        names = [f"_{n}{i}" for i in range(len(self.members)) for n in ("raw", "cal")]
        return df.withColumn(out, total / len(self.members)).drop(*names)


def fit_calibrated(
    df: DataFrame, fit: Fit, folds: list[tuple[Column, Column]], method: str = "isotonic", target: str = "target", parallelism: int = 1
) -> CalibratedModel:
    """Fit on each fold's training rows and calibrate on its test rows."""
    from leadspark.operators.calibration import fit_calibrator

    def member(train: Column, test: Column):
        model = fit(df.where(train))
        return model, fit_calibrator(model.score(df.where(test), "p"), method, "p", target)

    return CalibratedModel(_in_threads([lambda a=a, b=b: member(a, b) for a, b in folds], parallelism))


def time_fold_conditions(folds: list[TimeFold], position: str = "position") -> list[tuple[Column, Column]]:
    return [(f.train(position), f.test(position)) for f in folds]


def class_fold_conditions(folds: int, fold: str = "fold") -> list[tuple[Column, Column]]:
    return [(F.col(fold) != i, F.col(fold) == i) for i in range(folds)]


def fit_beta_calibrated(df: DataFrame, fit: Fit, folds: list[tuple[Column, Column]], target: str = "target", parallelism: int = 1) -> CalibratedModel:
    """Beta calibration on out-of-fold scores, around a model fitted on all rows."""
    from leadspark.operators.calibration import fit_calibrator

    models = _in_threads([lambda a=a: fit(df.where(a)) for a, _ in folds], parallelism)
    oof = None
    for m, (_, test) in zip(models, folds):
        part = m.score(df.where(test), "p").select("p", target)
        oof = part if oof is None else oof.unionByName(part)
    calibrator = fit_calibrator(oof, "beta", "p", target)
    return CalibratedModel([(fit(df), calibrator)])


# ---- ensembles ----------------------------------------------------------------------------------


@dataclass
class BaggedModel:
    models: list

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        total: Column = F.lit(0.0)
        for i, m in enumerate(self.models):
            df = m.score(df, f"_b{i}")
            total = total + F.col(f"_b{i}")
        return df.withColumn(out, total / len(self.models)).drop(*[f"_b{i}" for i in range(len(self.models))])


def fit_bagging(
    df: DataFrame, fit: Fit, n_bags: int = N_BAGS, target: str = "target", key: str = "row_key", ratio: float = 1.0, seed: int = 42, parallelism: int = 1
) -> BaggedModel:
    """One model per balanced bag: all minority rows and as many random majority rows."""
    bags = balanced_bags(df, n_bags, target, key, seed, ratio)

    def one(b: int):
        return fit(bags.rows(b))

    return BaggedModel(_in_threads([lambda b=b: one(b) for b in range(n_bags)], parallelism))


@dataclass
class StackedModel:
    bases: dict
    meta: FittedModel

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        names = []
        for name, m in self.bases.items():
            df = m.score(df, f"_s_{name}")
            names.append(f"_s_{name}")
        vec = VectorAssembler(inputCols=names, outputCol="_stack").transform(df)
        return self.meta.score(vec, out).drop("_stack", *names)


def stacking_bases(
    n_bags: int = 50, boosted: dict | None = None, second: dict | None = None, tree: dict | None = None, pos_weight: float = 1.0, seed: int = 42
) -> dict[str, Fit]:
    """Three different answers to imbalance: balanced weights, positive weight, undersampled bags."""
    return {
        "balanced": lambda d: fit_model(d, seed=seed, **(boosted or dict(kind="gbt", maxIter=200, stepSize=0.07, maxDepth=6, minInstancesPerNode=50))),
        "weighted": lambda d: fit_model(d, seed=seed, balanced=False, pos_weight=pos_weight, **(second or BACKENDS["boosted_deep"])),
        "bagged": lambda d: fit_bagging(d, lambda b: fit_model(b, balanced=False, seed=seed, **(tree or BACKENDS["bag_tree"])), n_bags, seed=seed),
    }


def fit_stacking(
    df: DataFrame, bases: dict[str, Fit], folds: int = 5, calibrate: str | None = "isotonic", target: str = "target", key: str = "row_key", seed: int = 42, parallelism: int = 1
) -> StackedModel:
    """Calibrated bases, a balanced logistic model on their out-of-fold probabilities."""
    if len(bases) < 2:
        raise ValueError("stacking needs at least two base models")

    def calibrated(fit: Fit) -> Fit:
        if calibrate is None:
            return fit

        def run(d: DataFrame):
            inner = cut(stratified_folds(d.drop("fold"), folds, target, key, seed + 1))
            return fit_calibrated(inner, fit, class_fold_conditions(folds), calibrate, target)

        return run

    fits = {name: calibrated(f) for name, f in bases.items()}
    folded = cut(stratified_folds(df, folds, target, key, seed))
    names = [f"_s_{n}" for n in fits]

    def fold_scores(i: int) -> DataFrame:
        train, held = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
        for name, f in fits.items():
            held = f(train).score(held, f"_s_{name}")
        return held.select(key, target, *names)

    parts = _in_threads([lambda i=i: fold_scores(i) for i in range(folds)], parallelism)
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    stacked = cut(VectorAssembler(inputCols=names, outputCol="_stack").transform(oof))
    meta = fit_model(stacked, "logit", features="_stack", target=target, C=1.0, maxIter=1000)
    full = folded.drop("fold")
    return StackedModel({name: f(full) for name, f in fits.items()}, meta)


@dataclass
class TwoStageModel:
    """Filter-then-rank model; stage features may differ."""

    stage1: FittedModel
    stage2: object
    threshold: float
    recall: float
    precision: float
    class_balance: float
    filtered: DataFrame | None = field(default=None, repr=False)

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        both = self.stage2.score(self.stage1.score(df, "_p1"), "_p2")
        return both.withColumn(out, merge_two_stage(F.col("_p1"), F.col("_p2"), F.lit(self.threshold))).drop("_p1", "_p2")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.score(df, "_p").withColumn(out, (F.col("_p") >= 0.5).cast("int")).drop("_p")

    def passes_filter(self, df: DataFrame, out: str = "passed") -> DataFrame:
        return self.stage1.score(df, "_p1").withColumn(out, F.col("_p1") >= self.threshold).drop("_p1")

    def diagnostics(self) -> dict:
        return {
            "stage1_threshold": self.threshold,
            "stage1_recall": self.recall,
            "stage1_precision": self.precision,
            "stage2_class_balance": self.class_balance,
        }


def fit_two_stage(
    df: DataFrame,
    stage1: Fit | None = None,
    stage2: Fit | None = None,
    target_recall: float = TARGET_RECALL,
    folds: int = STAGE1_FOLDS,
    calibrate: bool = True,
    target: str = "target",
    key: str = "row_key",
    seed: int = 42,
    parallelism: int = 1,
) -> TwoStageModel:
    """Out-of-fold first-stage scores set a high-recall threshold; the second stage learns on what passes it.

    The threshold comes from out-of-fold scores and is applied to the scores of
    the first stage fitted on all rows.
    """
    stage1 = stage1 or (lambda d: fit_backend(d, "filter_logit"))
    stage2 = stage2 or (lambda d: fit_backend(d, "two_stage_rank"))
    oof = cut(out_of_fold(df, stage1, folds, target, key, seed, parallelism, "_oof"))
    at = M.recall_threshold(oof, target_recall, target=target, score="_oof").first()
    filtered = oof.where(F.col("_oof") >= at["threshold"]).drop("_oof")
    stats = M.positives_share(filtered, target).first()
    second = stage2(filtered)
    if calibrate and stats["positives"] > CALIBRATE_ABOVE and stats["positives"] < stats["n_rows"]:
        k = min(3, folds)
        inner = cut(stratified_folds(filtered, k, target, key, seed + 1))
        second = fit_calibrated(inner, stage2, class_fold_conditions(k), "isotonic", target, parallelism)
    return TwoStageModel(stage1(df), second, float(at["threshold"]), float(at["recall"]), float(at["precision"]), float(stats["rate"] or 0.0))


def stage_vectors(df: DataFrame, stage1: list[str], stage2: list[str]) -> DataFrame:
    """Two vector columns from the columns that exist of each stage's list."""
    have = set(df.columns)
    for out, cols in (("features1", stage1), ("features2", stage2)):
        df = VectorAssembler(inputCols=[c for c in cols if c in have], outputCol=out).transform(df)
    return df


def two_stage_with_columns(df: DataFrame, stage1_kind: dict | None = None, stage2_kind: dict | None = None, **kw) -> TwoStageModel:
    """Two-stage model on ``features1`` and ``features2``."""
    one = stage1_kind or BACKENDS["filter_logit"]
    two = stage2_kind or BACKENDS["two_stage_rank"]
    return fit_two_stage(df, lambda d: fit_model(d, features="features1", **one), lambda d: fit_model(d, features="features2", **two), **kw)


# ---- search -------------------------------------------------------------------------------------


def draw_params(grid: dict[str, list], n_iter: int, seed: int = 42) -> list[dict]:
    """Different random combinations, at most as many as the grid has."""
    total = int(np.prod([len(v) for v in grid.values()]))
    picks = np.random.default_rng(seed).choice(total, size=min(n_iter, total), replace=False)
    out = []
    for p in picks:
        combo, rest = {}, int(p)
        for name, values in grid.items():
            rest, i = divmod(rest, len(values))
            combo[name] = values[i]
        out.append(combo)
    return out


@dataclass
class SearchResult:
    best_params: dict
    best_score: float
    model: FittedModel
    trials: list


def random_search(
    df: DataFrame,
    folds: list[TimeFold],
    grid: dict[str, list] | None = None,
    n_iter: int = SEARCH_ITERATIONS,
    k: int = 1000,
    kind: str = "gbt",
    target: str = "target",
    key: str = "row_key",
    seed: int = 42,
    parallelism: int = 1,
    **fixed,
) -> SearchResult:
    """Average precision over expanding time folds decides; the best setting is refitted on all rows.

    ``df`` carries ``position``; precision at k is recorded beside.
    """
    combos = draw_params(grid or SEARCH_GRID, n_iter, seed)

    def trial(c: int, f: TimeFold) -> dict:
        model = fit_model(df.where(f.train()), kind, target=target, seed=seed, **fixed, **combos[c])
        scored = cut(model.score(df.where(f.test()), "p").select(key, target, "p"))
        ap = M.average_precision(scored, target=target, score="p").first()[0]
        top = M.at_k(scored, k, target, "p", key).first()["precision_at_k"]
        return {"candidate": c, "fold": f.fold, "average_precision": float(ap), "precision_at_k": float(top)}

    trials = _in_threads([lambda c=c, f=f: trial(c, f) for c in range(len(combos)) for f in folds], parallelism)
    mean = {c: float(np.mean([t["average_precision"] for t in trials if t["candidate"] == c])) for c in range(len(combos))}
    best = max(mean, key=lambda c: (mean[c], -c))
    return SearchResult(combos[best], mean[best], fit_model(df, kind, target=target, seed=seed, **fixed, **combos[best]), trials)


def search_frames(
    pairs: list[tuple[DataFrame, DataFrame]],
    fit_of: Callable[[dict], Fit],
    refit: Callable[[dict], object],
    grid: dict[str, list],
    n_iter: int = SEARCH_ITERATIONS,
    k: int = 1000,
    target: str = "target",
    key: str = "row_key",
    seed: int = 42,
    parallelism: int = 1,
) -> SearchResult:
    """Average precision over (training, test) frames decides, whatever backend ``fit_of`` fits.

    Each pair is encoded by a preprocessor of its own training rows beforehand, so
    all candidates share it; ``refit`` fits the best setting on all rows.
    """
    combos = draw_params(grid, n_iter, seed)

    def trial(c: int, f: int) -> dict:
        train, test = pairs[f]
        scored = cut(fit_of(combos[c])(train).score(test, "p").select(key, target, "p"))
        ap = M.average_precision(scored, target=target, score="p").first()[0]
        top = M.at_k(scored, k, target, "p", key).first()["precision_at_k"]
        return {"candidate": c, "fold": f, "average_precision": float(ap), "precision_at_k": float(top)}

    trials = _in_threads([lambda c=c, f=f: trial(c, f) for c in range(len(combos)) for f in range(len(pairs))], parallelism)
    mean = {c: float(np.mean([t["average_precision"] for t in trials if t["candidate"] == c])) for c in range(len(combos))}
    best = max(mean, key=lambda c: (mean[c], -c))
    return SearchResult(combos[best], mean[best], refit(combos[best]), trials)


def choose_parameters(known: dict | None, saved: Callable[[], tuple | None], search: Callable[[], SearchResult], force_search: bool = True):
    """(source, result): known parameters, else a saved model, else a search; ``force_search`` skips to the last."""
    if not force_search and known is not None:
        return "known", known
    if not force_search:
        found = saved()
        if found is not None and found[0] is not None:
            return "saved", found
    return "search", search()


# ---- importances --------------------------------------------------------------------------------


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names from the vector's metadata, generic ones where it has none."""
    attrs = df.schema[features].metadata.get("ml_attr", {})
    named = [a for group in attrs.get("attrs", {}).values() for a in group]
    names = {a["idx"]: a.get("name", f"feat_{a['idx']}") for a in named}
    return [names.get(i, f"feat_{i}") for i in range(int(attrs.get("num_attrs", len(names))))]


def native_importance(fitted: FittedModel, names: list[str]) -> DataFrame:
    """(feature, importance) of a tree model's gains or a linear model's absolute coefficients."""
    m = fitted.model
    values = m.featureImportances if hasattr(m, "featureImportances") else m.coefficients
    rows = [(n, float(abs(v))) for n, v in zip(names, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def source_column(feature: Column) -> Column:
    """Source of a derived feature: text before ``=``, or before a trailing ``__digits``."""
    plain = F.regexp_extract(feature, r"^(.*)__\d+$", 1)
    return F.when(F.contains(feature, F.lit("=")), F.substring_index(feature, "=", 1)).when(plain != "", plain).otherwise(feature)


def importance_by_source(importance: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Importances summed per source column, by a (feature, source) frame or by name."""
    if sources is not None:
        named = importance.join(F.broadcast(sources), "feature", "left").withColumn("source", F.coalesce("source", source_column(F.col("feature"))))
    else:
        named = importance.withColumn("source", source_column(F.col("feature")))
    return named.groupBy("source").agg(F.sum("importance").alias("importance"))


def permutation_importance(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], columns: list[str], target: str = "target", key: str = "row_key", repeats: int = 7, seed: int = 42
) -> DataFrame:
    """Mean drop in ROC-AUC when one column is shuffled.

    Each repeat pairs every row with another one by two hash orders, once for all
    columns; ``score`` turns a frame with the columns into one with ``p``.
    """
    from leadspark.operators.ranking import hash_ranked

    base = float(M.auc(score(df).select(target, "p"), target=target, score="p").first()[0])
    drops: dict[str, list[float]] = {c: [] for c in columns}
    for r in range(repeats):
        left = hash_ranked(df, F.col(key), seed + 2 * r, [], out="_at")
        right = hash_ranked(df.select(key, *columns), F.col(key), seed + 2 * r + 1, [], out="_at")
        paired = cut(left.join(right.select("_at", *[F.col(c).alias(f"_other_{c}") for c in columns]), "_at"))
        for c in columns:
            shuffled = paired.withColumn(c, F.col(f"_other_{c}")).select(*df.columns)
            a = M.auc(score(shuffled).select(target, "p"), target=target, score="p").first()[0]
            drops[c].append(base - float(a))
    rows = [(c, float(np.mean(v))) for c, v in drops.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
