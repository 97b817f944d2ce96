"""The three end-to-end jobs: train and score, refresh the register, profile a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date
from leadspark.operators import metrics as M
from leadspark.operators import models as L
from leadspark.operators import profile as P
from leadspark.operators import register as R
from leadspark.operators import sinks
from leadspark.operators.encoders import LeadPreprocessor
from leadspark.operators.panel import PanelSpec, add_temporal_features, current_prospects, feature_sources, modeling_panel
from leadspark.operators.ranking import rank_leads
from leadspark.operators.sampling import business_sample, parse_sampling_strategy, smote, stratified_sample
from leadspark.operators.splits import date_folds, distinct_dates, split_by_dates
from leadspark.schema import RoleSchema
from leadspark.session import cut, store


@dataclass(frozen=True)
class TrainConfig:
    """Defaults of the training job.

    ``max_samples`` bounds the labelled rows a model is fitted on (None, as by
    default: all rows); ``small_canton_limit`` bounds the positives that business sampling
    keeps outside the big cantons (None: all). Search and calibration cut their
    folds by snapshot date, ``months_gap`` months apart, with as many folds as
    the dates allow up to the given numbers.
    """

    backend: str = "hgb"
    capacity: int = 1000
    beta: float = 2.0
    calibration: str = "isotonic"
    search_iterations: int = 10
    search_folds: int = 4
    calibration_folds: int = 3
    months_gap: int = 2
    max_samples: int | None = None
    small_canton_limit: int | None = None
    business_sampling: bool = False
    n_bags: int = 30
    known_params: dict | None = None  # None: those that an earlier search of the backend ended with
    use_known: bool = False
    force_search: bool = True
    holdout_validation: bool = True
    parallelism: int = 4
    overrides: dict | None = None
    search_grid: dict | None = None
    smote_ratio: str | float | None = None


def _fit_function(config: TrainConfig, params: dict) -> L.Fit:
    """How the chosen backend fits a frame with ``features``."""
    over = {**(config.overrides or {}), **params}
    n_bags = int(over.pop("n_bags", config.n_bags))
    if config.backend == "two_stage":
        return lambda d: L.fit_two_stage(d, stage2=lambda x: L.fit_backend(x, "two_stage_rank", **over), parallelism=config.parallelism)
    if config.backend == "stacking":
        return lambda d: L.fit_stacking(d, L.stacking_bases(pos_weight=float(L.class_weight_table(d).first()["scale_pos_weight"])), parallelism=config.parallelism)
    if config.backend == "hgb_bagging":
        return lambda d: L.fit_bagging(d, lambda b: L.fit_backend(b, "hgb_bagging", **over), n_bags, parallelism=config.parallelism)
    if config.backend == "rank":
        return lambda d: L.fit_model(d, kind="rank", **{"maxIter": 100, **over})
    return lambda d: L.fit_backend(d, config.backend, **over)


def _oversampled(encoded: DataFrame, ratio: float) -> DataFrame:
    """Training rows with synthetic ones of the smaller class."""
    grown = smote(encoded.select("row_key", "target", _dense("features")), ratio=ratio)
    return _back_to_vectors(grown).select("row_key", "target", "features")


def encode_fold(train: DataFrame, tests: list[DataFrame], config: TrainConfig) -> tuple[LeadPreprocessor, DataFrame, list[DataFrame]]:
    """Preprocessor of the training rows alone, those rows encoded (and grown), and the test rows encoded."""
    pre, encoded = LeadPreprocessor().fit_transform(train, keep=["row_key", "target"])
    if config.smote_ratio is not None:
        encoded = _oversampled(encoded, float(parse_sampling_strategy(config.smote_ratio)))
    return pre, cut(encoded, spread=True), [cut(pre.transform(pre.sources(t, ["row_key", "target"])).select("row_key", "target", "features")) for t in tests]


def encoded_fit(config: TrainConfig, params: dict) -> L.Fit:
    """Fits the backend on raw rows: preprocessing and oversampling are part of each fit."""

    def fit(rows: DataFrame) -> L.EncodedModel:
        pre, encoded, _ = encode_fold(rows, [], config)
        return L.EncodedModel(pre, _fit_function(config, params)(encoded))

    return fit


def train_and_score(companies: DataFrame, spec: PanelSpec, out: str, config: TrainConfig | None = None, panel: DataFrame | None = None) -> dict:
    """Panel, features, search, calibration, threshold report, gains, ranked leads.

    With a given ``panel`` (a cached export) no prospects are scored. Validation
    rows stay out of training unless ``holdout_validation`` is off. Every fold has
    a preprocessor of its own; test rows are real ones and never shape it.
    """
    config = config or TrainConfig()
    cached = panel is not None
    frame = _narrow(add_temporal_features(panel if cached else modeling_panel(companies, spec)), ["row_key", "target", "snapshot_date"])
    if not cached:
        frame = store(frame, "panel")  # split, sampling, reports read it; the joins behind it run once
    train, val, test = split_by_dates(frame)
    learn = train if config.holdout_validation else train.unionByName(val)
    if config.max_samples is not None:
        if config.business_sampling:
            learn = business_sample(learn, config.max_samples, limit=config.small_canton_limit)
        else:
            learn = stratified_sample(learn, config.max_samples)
    learn = cut(learn, spread=True)
    dates = sorted(r[0] for r in distinct_dates(learn).collect())  # bounded: split_by_dates has counted them

    def search():
        if config.backend not in L.SEARCH_GRIDS:
            return L.SearchResult({}, float("nan"), None, [])
        pairs = []
        for a, b in date_folds(dates, config.search_folds, config.months_gap):
            _, encoded, (tested,) = encode_fold(learn.where(a), [learn.where(b)], config)
            pairs.append((encoded, tested))
        return L.search_frames(
            pairs,
            lambda params: _fit_function(config, params),
            lambda params: encoded_fit(config, params)(learn),
            config.search_grid or L.SEARCH_GRIDS[config.backend],
            config.search_iterations,
            config.capacity,
            parallelism=config.parallelism,
        )

    known = config.known_params if config.known_params is not None else L.KNOWN_BEST.get(config.backend) if config.use_known else None
    source, found = L.choose_parameters(known, lambda: _saved_params(f"{out}/search"), search, config.force_search)
    params = found if source == "known" else found[1] if source == "saved" else found.best_params
    if source == "search" and found.model is not None and isinstance(found.model.model, L.FittedModel) and found.model.model.model is not None:
        sinks.save_model(found.model.model.model, f"{out}/search", found.best_params, found.best_score, config.search_iterations)

    fit = encoded_fit(config, params)
    folds = date_folds(dates, config.calibration_folds, config.months_gap)
    if config.calibration == "beta":
        model = L.fit_beta_calibrated(learn, fit, folds, parallelism=config.parallelism)
    else:
        model = L.fit_calibrated(learn, fit, folds, config.calibration, parallelism=config.parallelism)
    pre = LeadPreprocessor().fit(learn)  # for reports; each member of the model has its own

    def scored(df: DataFrame) -> DataFrame:
        return cut(model.score(df, "p").select("row_key", "target", "p"))

    scored_val, scored_test = scored(val), scored(test)
    report = M.threshold_report(scored_val, scored_test, config.capacity, config.beta, config.calibration, score="p")
    sinks.write_report(report, f"{out}/thresholds")
    gains = M.gains_table(scored_test, score="p").orderBy("decile")
    sinks.write_csv(gains, f"{out}/gains_table_test", single_file=True)
    pre.write().overwrite().save(f"{out}/preprocessor")

    result = {"source": source, "params": params, "model": model, "preprocessor": pre, "report": report, "gains": gains, "leads": None}
    if not cached:
        today = _narrow(add_temporal_features(current_prospects(companies, spec)), ["company_id", "company_name", "snapshot_date"])
        p = model.score(today, "p_convert").select("company_id", "company_name", iso_date(F.col("snapshot_date")).alias("snapshot_date"), "p_convert")
        leads = rank_leads(cut(p))
        sinks.write_ranked_leads(leads, f"{out}/ranked_leads")
        result["leads"] = leads
    return result


def _narrow(df: DataFrame, keep: list[str]) -> DataFrame:
    """What the preprocessor reads, and ``keep``."""
    return feature_sources(df, RoleSchema().features, keep)


def _saved_params(path: str):
    from pyspark.ml.classification import GBTClassificationModel

    return sinks.load_model(path, GBTClassificationModel)


def _dense(col: str):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(col).alias(col)


def _back_to_vectors(df: DataFrame, col: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(col, array_to_vector(col))


def refresh_register(events: DataFrame, out: str) -> DataFrame:
    """Rebuild the monthly cube and write it with its dimensions and status."""
    cube = cut(R.monthly_cube(events))
    sinks.write_register(R.ordered_cube(cube), R.dimensions(cube), R.status(cube), out)
    return cube


def profile_table(df: DataFrame, out: str, text_columns: list[str] | None = None) -> dict[str, DataFrame]:
    """All profile tables of a frame; the numeric description, categories and summary are written as CSV."""
    kinds = P.columns_by_kind(df)
    texts = text_columns or kinds["string"]
    tables = {
        "overview": P.overview(df),
        "missing": P.missing_table(df).orderBy(F.desc("missing_percentage"), "column"),
        "numeric": P.describe_table(df, kinds["numeric"]),
        "numeric_extra": P.numeric_extras(df, kinds["numeric"]),
        "categories": P.top_categories(df, texts, 20),
        "dates": P.date_table(df, kinds["date"]),
    }
    if "founding_year" in df.columns:
        tables["decades"] = P.decade_table(df, "founding_year")
    if "postal_code" in df.columns:
        tables["regions"] = P.region_table(df, "postal_code")
        tables["postal"] = P.postal_numbers(df, "postal_code")
    industry = P.industry_columns(df)
    if industry:
        tables["industries"] = P.top_categories(df, industry, 10)
    for name, table in tables.items():
        sinks.write_csv(table, f"{out}/{name}", single_file=True)
    return tables


def export_training_panel(spark: SparkSession, companies: DataFrame, spec: PanelSpec, path: str, source: str) -> DataFrame:
    """Freeze the panel for later runs and read it back."""
    from leadspark.sources.cache import read_cache, write_cache

    write_cache(modeling_panel(companies, spec), path, spec.horizon_months, source)
    return read_cache(spark, path)[0]
