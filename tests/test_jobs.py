import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadspark.operators import register as R
from leadspark.operators import sinks
from leadspark.plans import jobs
from leadspark.plans.frames import SPEC, current
from leadspark.session import scratch_path, shared_dir
from leadspark.sources.cache import read_cache
from leadspark.sources.tables import companies

SMALL = dict(search_iterations=2, search_folds=2, calibration_folds=2, capacity=20, search_grid={"maxDepth": [2, 3], "maxIter": [2]}, overrides={"maxIter": 2, "maxDepth": 3})


def test_train_and_score(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    out = str(tmp_path)
    result = jobs.train_and_score(companies(spark, sf), SPEC, out, jobs.TrainConfig(max_samples=2000, **SMALL))
    assert result["source"] == "search" and result["params"]["maxDepth"] in (2, 3)
    leads = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/ranked_leads")
    assert leads.count() == current(spark, sf).count() and leads.agg(F.max("rank")).first()[0] == leads.count()
    assert sorted(r[0] for r in leads.select("decile").distinct().collect()) == list(range(1, 11))
    report = json.loads(spark.read.text(f"{out}/thresholds").first()[0])
    assert report["k"] == 20 and {"validation", "test"} <= set(report) and report["test"]["topk_metrics"]["support"] == 1111
    assert spark.read.option("header", True).csv(f"{out}/gains_table_test").count() == 10
    again = jobs.train_and_score(companies(spark, sf), SPEC, out, jobs.TrainConfig(max_samples=2000, force_search=False, calibration="sigmoid", **SMALL))
    assert again["source"] == "saved" and again["params"] == result["params"]


@pytest.mark.parametrize("extra", [dict(calibration="beta", backend="rank"), dict(smote_ratio="0.2", known_params={}, force_search=False, business_sampling=True, max_samples=1500)])
def test_cached_panel_trains_without_prospects(spark, tmp_path, extra):
    sf = "/root/testdata/sf0.01"
    frozen = jobs.export_training_panel(spark, companies(spark, sf), SPEC, str(tmp_path / "cache"), "test")
    result = jobs.train_and_score(None, SPEC, str(tmp_path / "out"), jobs.TrainConfig(**{**SMALL, **extra}), panel=frozen)
    assert result["leads"] is None and result["gains"].count() == 10


def test_missing_cache_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_cache(spark, str(tmp_path / "nothing"))


def events(spark):
    rows = [(datetime(2024, m, d), k, t) for m in (1, 2, 4) for d in (1, 15, 28) for k in (" zh", "BE") for t in ("hr01", "HR03") if not (m == 4 and t == "HR03")]
    return spark.createDataFrame(rows, "publication_date timestamp_ntz, kanton string, shab_id string")


def test_register_cube(spark):
    cube = R.monthly_cube(events(spark))
    rows = {(r["month"], r["geo"], r["kanton"], r["hr"]): r["count"] for r in cube.collect()}
    assert rows["2024-01-01", "KT", "ZH", "HR01"] == 3 and rows["2024-01-01", "CH", None, "HR01"] == 6
    assert rows["2024-01-01", "CH", None, "NET"] == 0 and rows["2024-04-01", "KT", "BE", "NET"] == 3
    assert ("2024-04-01", "KT", "BE", "HR03") not in rows


def test_both_types_exist_even_if_one_never_occurs(spark):
    only = events(spark).where("upper(shab_id) = 'HR01'")
    wide = R.by_type(R.monthly_counts(only))
    assert wide.agg(F.sum("HR03")).first()[0] == 0 and wide.where("NET <> HR01").count() == 0


def test_dashboard_views(spark):
    cube = R.monthly_cube(events(spark))
    assert [r["month"] for r in R.visible_months(cube, 2).orderBy("month").collect()] == ["2024-02-01", "2024-04-01"]
    series = {r["month"]: r["count"] for r in R.time_series(cube, R.DELETION, 0, R.CANTON, "ZH").collect()}
    assert series == {"2024-01-01": 3, "2024-02-01": 3, "2024-04-01": 0}
    assert R.heat_map(cube, R.ENTRY, 2).count() == 4


def test_refresh_writes_everything(spark, tmp_path):
    jobs.refresh_register(events(spark), str(tmp_path))
    dims = json.loads(spark.read.text(str(tmp_path / "dimensions")).first()[0])
    assert dims == {"metrics": ["HR01", "HR03", "NET"], "cantons": ["BE", "ZH"], "months": ["2024-01-01", "2024-02-01", "2024-04-01"]}
    status = json.loads(spark.read.text(str(tmp_path / "status")).first()[0])
    assert status["months_covered"] == 3 and status["cantons_covered"] == 2
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "shab_monthly")).collect()]
    assert len(lines) == status["records"] and any(r["kanton"] is None and r["geo"] == "CH" for r in lines)


def test_profile_writes_tables(spark, sf, tmp_path):
    tables = jobs.profile_table(current(spark, sf).drop("row_key"), str(tmp_path), ["canton", "size_class"])
    assert {"missing", "numeric", "categories", "dates", "decades", "regions", "industries"} <= set(tables)
    assert spark.read.option("header", True).csv(str(tmp_path / "numeric")).count() == 7


def test_table_sink_replaces(spark, tmp_path):
    for n in (3, 5):
        sinks.write_table(spark.range(n), "sink_test", str(tmp_path / f"t{n}"))
        assert spark.table("sink_test").count() == n


def test_missing_model(spark, tmp_path):
    assert sinks.load_model(str(tmp_path / "none"), None) == (None, None, None)


def test_shared_folder_is_taken_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_test_labels_do_not_reach_training_features(spark):
    """Other labels in a test fold leave the fold's training rows and its preprocessor as they were; no synthetic row is tested."""
    from leadspark.operators.panel import add_temporal_features, modeling_panel
    from leadspark.operators.splits import date_folds, distinct_dates

    frame = add_temporal_features(modeling_panel(companies(spark, "/root/testdata/sf0.001"), SPEC))
    dates = sorted(r[0] for r in distinct_dates(frame).collect())
    train, test = date_folds(dates, 2, 2)[-1]
    config = jobs.TrainConfig(smote_ratio="0.6")
    flipped = frame.withColumn("target", F.when(test, 1 - F.col("target")).otherwise(F.col("target")).cast("int"))
    seen = []
    for df in (frame, flipped):
        _, encoded, (tested,) = jobs.encode_fold(df.where(train), [df.where(test)], config)
        seen.append((sorted(map(repr, encoded.collect())), sorted(repr(r["features"]) for r in tested.collect())))
        assert encoded.where("row_key < 0").count() > 0 and tested.where("row_key < 0").count() == 0
    assert seen[0] == seen[1]


def test_events_without_a_canton_count_for_the_country(spark):
    more = events(spark).unionByName(events(spark).limit(1).withColumn("kanton", F.lit(None).cast("string")))
    cube = R.monthly_cube(more)
    assert cube.where("geo = 'KT' AND kanton IS NULL").count() == 0
    assert cube.where("geo = 'CH' AND hr <> 'NET'").agg(F.sum("count")).first()[0] == more.count()


def test_stream_without_input_gives_no_rows(spark, tmp_path):
    from leadspark.streaming.register_stream import counts_once

    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("publication_date timestamp_ntz, kanton string, shab_id string").parquet(str(tmp_path / "in"))
    assert counts_once(spark, stream).collect() == []


def test_all_training_rows_are_learned_from_by_default(spark, tmp_path, monkeypatch):
    """The query names no bound, so neither search, models nor thresholds come from a sample."""
    from leadspark.operators.panel import modeling_panel
    from leadspark.operators.splits import split_by_dates
    from leadspark.plans import q_jobs

    class Reached(Exception):
        pass

    seen = []

    def learned(df):
        seen.append(df.count())
        raise Reached

    def never(*args, **kw):
        raise AssertionError("rows were sampled")

    monkeypatch.setattr(jobs, "distinct_dates", learned)
    monkeypatch.setattr(jobs, "stratified_sample", never)
    monkeypatch.setattr(jobs, "business_sample", never)
    sf = "/root/testdata/sf0.001"
    with pytest.raises(Reached):
        q_jobs.job_train_and_score(spark, sf)
    assert seen == [split_by_dates(modeling_panel(companies(spark, sf), SPEC))[0].count()]
