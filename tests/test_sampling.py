from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadspark.operators import sampling as A
from leadspark.operators import splits as L


def panel(spark, n=4000, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "row_key": np.arange(n, dtype="int64"),
            "company_id": np.arange(n, dtype="int64"),
            "target": (rng.random(n) < 0.08).astype(int),
            "canton": rng.choice(["ZH", "BE", "UR", "GL"], n, p=[0.6, 0.2, 0.1, 0.1]),
            "size_class": rng.choice(["MICRO", "KLEIN", "GROSS"], n, p=[0.8, 0.15, 0.05]),
            "legal_form": rng.choice(["GmbH", "Stiftung"], n),
            "snapshot_date": rng.choice([datetime(2020, 1, 1), datetime(2021, 1, 1), datetime(2022, 1, 1)], n),
        }
    )
    return pdf, spark.createDataFrame(pdf).withColumn("snapshot_date", F.col("snapshot_date").cast("timestamp_ntz"))


def test_small_frames_come_back_whole(spark):
    _, df = panel(spark, 50)
    assert A.stratified_sample(df, 50).count() == 50
    assert A.business_sample(df, 60).count() == 50


def test_quotas_are_met_exactly(spark):
    _, df = panel(spark)
    marked = A.with_stratum(df, "target")
    quotas = A.strata_quotas(A.strata_sizes(marked), 1000).toPandas().set_index("stratum")["quota"]
    got = A.with_stratum(A.stratified_sample(df, 1000), "target").groupBy("stratum").count().toPandas().set_index("stratum")["count"]
    assert (got.sort_index() == quotas.sort_index()).all()
    assert (quotas >= 1).all() and quotas.sum() <= 1000 + len(quotas)


def test_sample_keeps_the_target_share(spark):
    pdf, df = panel(spark)
    got = A.stratified_sample(df, 1500).toPandas()
    assert abs(got["target"].mean() - pdf["target"].mean()) < 0.02
    assert not got["row_key"].duplicated().any()
    shift = A.distribution_shift(df, spark.createDataFrame(got[["row_key", "canton"]]), "canton").toPandas()
    assert shift["diff_points"].max() < 2


def test_sampling_is_stable_under_reordering(spark):
    _, df = panel(spark)
    a = {r[0] for r in A.stratified_sample(df, 700).select("row_key").collect()}
    b = {r[0] for r in A.stratified_sample(df.orderBy(F.rand(1)).repartition(11), 700).select("row_key").collect()}
    assert a == b


def test_preserved_positives(spark):
    pdf, df = panel(spark)
    pos = pdf[pdf["target"] == 1]
    large, outside = pos["size_class"] == "GROSS", ~pos["canton"].isin(A.BIG_CANTONS)
    assert A.preserved_positives(df).count() == (large | outside).sum()
    assert A.preserved_positives(df, keep_duplicates=True).count() == large.sum() + outside.sum()
    kept = {r[0] for r in A.business_sample(df, 1500).select("row_key").collect()}
    assert set(pos[large | outside]["row_key"]) <= kept


def test_null_canton_counts_as_outside(spark):
    df = spark.createDataFrame([(1, 1, None, "MICRO"), (2, 1, "ZH", "MICRO")], "row_key long, target int, canton string, size_class string")
    assert [r["row_key"] for r in A.preserved_positives(df).collect()] == [1]


def test_balanced_bags(spark):
    pdf, df = panel(spark)
    n_pos = pdf["target"].sum()
    bags = [A.balanced_bag(df, b).toPandas() for b in (0, 1)]
    for bag in bags:
        assert (bag["target"] == 1).sum() == (bag["target"] == 0).sum() == n_pos
    assert set(bags[0]["row_key"]) != set(bags[1]["row_key"])
    half = A.balanced_bag(df, 0, ratio=0.5)
    assert half.where("target = 0").count() == 2 * n_pos
    assert A.balanced_bag(df.where("target = 0"), 0).count() == len(pdf) - n_pos


def test_parse_sampling_strategy():
    assert A.parse_sampling_strategy(" Auto ") == "auto" and A.parse_sampling_strategy("0.1") == 0.1
    assert A.parse_sampling_strategy(None) is None and A.parse_sampling_strategy(0.5) == 0.5
    assert A.parse_sampling_strategy("other words") == "other words"


def test_smote_reaches_the_ratio_between_neighbours(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i < 20), [float(x) for x in rng.normal(size=2) + (5 if i < 20 else 0)]) for i in range(520)]
    df = spark.createDataFrame(rows, "row_key long, target int, features array<double>")
    out = A.smote(df, ratio=0.1).toPandas()
    made = out[out["synthetic"]]
    assert (out["target"] == 1).sum() == 50 and len(made) == 30 and (made["target"] == 1).all()
    minority = np.array([r[2] for r in rows[:20]])
    pts = np.array(made["features"].tolist())
    assert (pts >= minority.min(axis=0) - 1e-9).all() and (pts <= minority.max(axis=0) + 1e-9).all()
    assert not out["row_key"].duplicated().any()
    assert A.smote(df.where("target = 0")).count() == 500


def test_splits_by_date(spark):
    _, df = panel(spark, 300)
    train, val, test = L.split_by_dates(df)
    assert train.count() + val.count() + test.count() == 300
    assert train.agg(F.max("snapshot_date")).first()[0] < val.agg(F.min("snapshot_date")).first()[0] < test.agg(F.min("snapshot_date")).first()[0]
    with pytest.raises(ValueError):
        L.split_by_dates(train)


def test_folds_spread_each_class_evenly(spark):
    _, df = panel(spark, 1003)
    counts = L.stratified_folds(df, 5, rows_per_bucket=100).groupBy("target", "fold").count().toPandas()
    for _, part in counts.groupby("target"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_a_class_is_not_dealt_in_one_task(spark):
    df = spark.range(120_000).select(F.col("id").alias("row_key"), (F.col("id") % 100 == 0).cast("int").alias("target"))
    sizes = [r["n"] for r in L.stratified_folds(df, 5).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 120_000 and max(sizes) < 70_000


def test_positions_are_chronological_and_folds_disjoint(spark):
    _, df = panel(spark, 600)
    placed = L.with_position(df, rows_per_bucket=50).toPandas().sort_values("position")
    assert placed["position"].tolist() == list(range(600)) and placed["snapshot_date"].is_monotonic_increasing
    for f in L.time_folds(600, 4, 20):
        assert f.train_end < f.test_start < f.test_end


def test_gap_is_clamped(spark):
    _, df = panel(spark, 90)
    assert L.gap_rows(df) == 100
    _, df = panel(spark, 900)
    assert L.gap_rows(df) == 600


def test_smote_takes_very_large_keys(spark):
    rng = np.random.default_rng(0)
    rows = [(10**16 + i, int(i < 20), [float(x) for x in rng.normal(size=2)]) for i in range(520)]
    out = A.smote(spark.createDataFrame(rows, "row_key long, target int, features array<double>"), ratio=0.1).toPandas()
    assert out["synthetic"].sum() == 30 and not out["row_key"].duplicated().any() and (out[out["synthetic"]]["row_key"] < 0).all()


def test_date_folds_keep_the_months_between(spark):
    from datetime import datetime

    dates = [datetime(2023, m, 1) for m in (1, 4, 5, 9)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "id long, snapshot_date timestamp_ntz")
    parts = [([r["id"] for r in df.where(a).collect()], [r["id"] for r in df.where(b).collect()]) for a, b in L.date_folds(dates, 4, 2)]
    assert [(sorted(a), b) for a, b in parts] == [([0], [1]), ([0], [2]), ([0, 1, 2], [3])]
    with pytest.raises(ValueError):
        L.date_folds(dates[:1], 4, 2)


def test_all_bags_at_once_equal_single_bags(spark, monkeypatch):
    rows = spark.range(40000).select((F.col("id") * 1000000 + 199806 + F.col("id") % 5).alias("row_key"), (F.col("id") % 9 == 0).cast("int").alias("target"))
    bags, ratio = 12, 0.5
    want = [{r[0] for r in A.balanced_bag(rows, b, ratio=ratio).select("row_key").collect()} for b in (0, 7, 11)]
    counted = []
    quota = A.hash_quota
    monkeypatch.setattr(A, "hash_quota", lambda *a, **kw: counted.append(1) or quota(*a, **kw))
    drawn = A.balanced_bags(rows, bags, ratio=ratio)
    assert [{r[0] for r in drawn.rows(b).select("row_key").collect()} for b in (0, 7, 11)] == want
    assert {drawn.rows(b).where("target = 0").count() for b in range(bags)} == {2 * 4445}
    assert not counted  # two passes were enough for every bag
    narrow = A.balanced_bags(rows, 2, ratio=ratio, spreads=0.0)  # every end lies outside the window
    assert {r[0] for r in narrow.rows(0).select("row_key").collect()} == want[0] and counted


def test_bags_of_one_class_and_of_nothing(spark):
    rows = spark.range(50).select(F.col("id").alias("row_key"), F.lit(0).alias("target"))
    assert A.balanced_bags(rows, 3).rows(2).count() == 50
    assert A.balanced_bags(rows.limit(0), 3).rows(0).count() == 0
    few = rows.withColumn("target", (F.col("row_key") < 30).cast("int"))
    assert A.balanced_bags(few, 2, ratio=0.01).rows(1).count() == 50  # no more rows than there are
