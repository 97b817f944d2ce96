import math

import numpy as np
import pytest

from leadspark.operators import metrics as M
from leadspark.operators.splits import time_folds


def scored(spark, y, p):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "row_key long, target int, score double")


def test_at_k(spark):
    df = scored(spark, [1, 1, 0, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5])
    for k, p, r in [(1, 1, 0.5), (2, 1, 1), (3, 2 / 3, 1), (5, 0.4, 1), (50, 0.4, 1), (0, 0, 0), (-1, 0, 0)]:
        row = M.at_k(df, k).first()
        assert row["precision_at_k"] == pytest.approx(p) and row["recall_at_k"] == pytest.approx(r)


def test_lift(spark):
    df = scored(spark, [1, 1] + [0] * 8, [0.9 - i / 10 for i in range(10)])
    assert M.at_k(df, 2).first()["lift_at_k"] == pytest.approx(5)
    assert M.at_k(scored(spark, [0, 0], [0.1, 0.2]), 1).first()["lift_at_k"] == 0


def test_top_k_threshold(spark):
    df = scored(spark, [1, 1, 0, 0], [0.9, 0.8, 0.1, 0.2])
    assert M.top_k_threshold(df, 2).first()[0] == pytest.approx(0.8)
    assert M.top_k_threshold(df, 99).first()[0] == pytest.approx(0.1)
    assert M.top_k_threshold(df, 0).first()[0] == 1.0
    assert M.top_k_threshold(scored(spark, [1], [float("nan")]), 3).first()[0] == 1.0


def test_fbeta_and_threshold(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    row = M.best_fbeta(df).first()
    assert row["threshold"] == pytest.approx(0.35) and 0 <= row["f_beta"] <= 1
    m = M.at_threshold(scored(spark, [0, 1, 1, 0], [0.2, 0.9, 0.8, 0.1]), 0.5).first()
    assert (m["precision"], m["recall"], m["support"], m["positives"], m["predicted_positives"]) == (1, 1, 4, 2, 2)


def test_empty_frames(spark):
    df = scored(spark, [], [])
    assert M.best_fbeta(df).first()["threshold"] == 0.5
    assert M.at_k(df, 5).first()["precision_at_k"] == 0
    assert M.youden_threshold(df).first()["threshold"] == 0.5
    assert M.ece_at_k(df, 5).first()[0] is None
    assert M.gains_table(df).count() == 0


def test_one_class(spark):
    df = scored(spark, [0, 0, 0], [0.1, 0.5, 0.2])
    assert M.auc(df).first()[0] is None
    assert M.average_precision(df).first()[0] == 0
    b = M.brier(df).first()
    assert b["brier_pos"] is None and b["brier_neg"] == pytest.approx((0.01 + 0.25 + 0.04) / 3)


def test_recall_threshold(spark):
    df = scored(spark, [0, 0, 1, 0, 1, 0, 0, 1, 0, 0], [0.1, 0.2, 0.8, 0.3, 0.7, 0.4, 0.35, 0.6, 0.15, 0.05])
    row = M.recall_threshold(df, 0.66).first()
    assert row["recall"] >= 0.66 and row["threshold"] == pytest.approx(0.7)


def brute(y, p):
    y, p = np.asarray(y), np.asarray(p)
    ap = auc = 0.0
    seen = tp = 0
    for t in sorted(set(p), reverse=True):
        m = p == t
        seen, tp = seen + m.sum(), tp + y[m].sum()
        ap += y[m].sum() / y.sum() * tp / seen
    for a in p[y == 1]:
        auc += (a > p[y == 0]).sum() + 0.5 * (a == p[y == 0]).sum()
    return ap, auc / (y.sum() * (1 - y).sum())


@pytest.mark.parametrize("rows_per_bucket", [5, 10**6])
def test_curves_against_brute_force(spark, rows_per_bucket):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 400), rng.integers(0, 60, 400) / 60
    df = scored(spark, y, p)
    ap, auc = brute(y, p)
    assert M.average_precision(df, rows_per_bucket=rows_per_bucket).first()[0] == pytest.approx(ap)
    assert M.auc(df, rows_per_bucket=rows_per_bucket).first()[0] == pytest.approx(auc)
    assert M.pr_curve(df).count() == len(set(p)) + 1
    roc = M.roc_curve(df, rows_per_bucket=rows_per_bucket).orderBy("fpr", "tpr").toPandas()
    assert roc["tpr"].is_monotonic_increasing and roc["tpr"].iloc[-1] == 1


def test_all_ties(spark):
    df = scored(spark, [1, 0, 0, 1], [0.5] * 4)
    assert M.auc(df).first()[0] == 0.5 and M.average_precision(df).first()[0] == 0.5
    assert [r["n"] for r in M.gains_table(df, bins=2).orderBy("decile").collect()] == [2, 2]


def test_ece_bins(spark):
    df = scored(spark, [1, 0, 1, 0], [1.0, 0.95, 0.3, 1.5])
    assert M.ece_at_k(df.where("score <= 1"), 10).first()[0] == pytest.approx((2 * abs(0.975 - 0.5) + abs(0.3 - 1)) / 3)
    assert M.ece_at_k(df, 10).first()[0] == pytest.approx((2 * abs(0.975 - 0.5) + abs(0.3 - 1)) / 4)


def test_gains_skip_missing_scores(spark):
    df = scored(spark, [1, 0, 1], [0.5, float("nan"), 0.2])
    assert M.gains_table(df).agg({"n": "sum"}).first()[0] == 2


def test_report_shape(spark):
    rng = np.random.default_rng(2)
    df = scored(spark, rng.integers(0, 2, 60), rng.random(60))
    row = M.threshold_report(df, df, 10, 2.0, "isotonic").first()
    assert row["validation"]["fbeta_metrics"]["threshold"] == row["fbeta_threshold"]
    assert row["validation"]["ap"] == row["test"]["ap"] and 0 <= row["test"]["brier"] <= 1
    assert not math.isnan(row["test"]["ece_at_k"])


def test_time_folds():
    folds = time_folds(100, 4, 10)
    assert [(f.train_end, f.test_start, f.test_end) for f in folds] == [(10, 20, 40), (30, 40, 60), (50, 60, 80), (70, 80, 100)]
    with pytest.raises(ValueError):
        time_folds(100, 4, 20)


def test_report_from_counts_equals_metrics_of_rows(spark):
    rng = np.random.default_rng(4)
    val, test = (scored(spark, rng.integers(0, 2, 300), np.round(rng.random(300), 1)) for _ in range(2))  # every score has many ties
    row = M.threshold_report(val, test, 37, 2.0, "none").first()
    assert row["fbeta_threshold"] == M.best_fbeta(val, 2.0).first()["threshold"] and row["top_k_threshold"] == M.top_k_threshold(val, 37).first()[0]
    for name, df in (("validation", val), ("test", test)):
        block = row[name]
        assert block["ap"] == pytest.approx(M.average_precision(df).first()[0])
        assert block["precision_at_k"] == pytest.approx(M.at_k(df, 37).first()["precision_at_k"])
        assert block["ece_at_k"] == pytest.approx(M.ece_at_k(df, 37).first()[0])
        assert [block[c] for c in ("brier", "brier_pos", "brier_neg")] == pytest.approx(list(M.brier(df).first()))
        for part, t in (("fbeta_metrics", row["fbeta_threshold"]), ("topk_metrics", row["top_k_threshold"])):
            assert list(block[part]) == pytest.approx(list(M.at_threshold(df, t).first()))


def test_report_edges(spark):
    some = spark.createDataFrame([(0, 1, 0.5), (1, 0, float("nan")), (2, 1, None)], "row_key long, target int, score double")
    row = M.threshold_report(some, some.limit(0), 5, 2.0, "none").first()
    assert row["validation"]["fbeta_metrics"]["support"] == 3 and row["validation"]["topk_metrics"]["predicted_positives"] == 1
    assert row["validation"]["precision_at_k"] == 1.0 and row["validation"]["brier"] == 0.25
    assert row["test"]["ap"] == 0.0 and row["test"]["precision_at_k"] == 0.0 and row["test"]["ece_at_k"] is None and row["test"]["fbeta_metrics"]["support"] == 0
    none = M.threshold_report(some, some, 0, 2.0, "none").first()
    assert none["top_k_threshold"] == 1.0 and none["test"]["precision_at_k"] == 0.0
