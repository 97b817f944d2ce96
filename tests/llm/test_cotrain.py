from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadspark.llm import cotrain
from leadspark.llm import textscan as ts
from tests.llm.frames import PROSE, awkward, cluttered, docs


def synthetic(seed, n, strength=(2.0, 2.0)):
    """Two noisy views of a hidden class."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.7).astype(float)
    x, m = rng.normal(size=(n, 6)), rng.normal(size=(n, 4))
    x[:, 0] += strength[0] * y
    m[:, 0] += strength[1] * y
    return x.astype(np.float32), m.astype(np.float32), y


def test_pseudo_labels_and_both_views_help():
    x, m, y = synthetic(1, 80)
    px, pm, _ = synthetic(2, 3000)
    hx, hm, hy = synthetic(3, 4000)
    model = cotrain.co_train(x, m, y, px, pm)
    a, b, both = model.scores(hx, hm)
    right = lambda p: float(((p >= 0.5) == hy).mean())
    assert right(both) > max(right(a), right(b)) > 0.75
    assert abs(both.mean() - hy.mean()) < 0.1  # calibrated
    alone = cotrain.co_train(x, m, y, px[:0], pm[:0])
    assert right(both) >= right(alone.scores(hx, hm)[2]) - 0.01


def test_uninformative_view_gets_no_say():
    x, m, y = synthetic(1, 1200, (4.0, 0.0))
    model = cotrain.co_train(x, m, y, *synthetic(2, 500, (4.0, 0.0))[:2])
    hx, hm, hy = synthetic(5, 2000, (4.0, 0.0))
    assert ((model.scores(hx, hm)[2] >= 0.5) == hy).mean() > 0.95


def test_held_out_accuracy_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    src, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0
    out = cotrain.judge(src, labels.filter(~held)).join(labels.filter(held), "doc_id").toPandas()
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert good.kept.mean() > 0.97 and bad.kept.mean() < 0.25


@pytest.mark.parametrize("most", [10_000, 100])
def test_pseudo_labels_come_from_the_whole_unlabelled_table(spark, most):
    n = 5_000  # more than any fixed pool held before
    rng = np.random.default_rng(4)
    weak = rng.random(n)
    texts = [" ".join("@#" if rng.random() < w else f"word{rng.integers(40)}" for _ in range(12)) for w in weak]
    df = cotrain._inputs(docs(spark, texts))
    known = spark.createDataFrame([(i, float(weak[i] < 0.5)) for i in range(400)], "doc_id long, y double")
    x = cotrain.text_view(next(ts.slices(pa.array(texts, pa.string()))))
    m = cotrain.meta_view([f"src{i % 3}" for i in range(n)], ["en"] * n, np.array([float(len(t)) for t in texts]))
    y = (weak[:400] < 0.5).astype(float)
    views = [cotrain.View.fit(x[:400], y), cotrain.View.fit(m[:400], y)]
    calibration = (np.array([3.0, 0.0]), np.array([0.0, 0.0]))  # the second view is never sure
    (gx, gy), (gm, gl) = cotrain.table_lender(df, known, most, 0.1)(views, calibration, 2, 0.5)
    assert len(gx) == len(gy) == 0
    odds = views[0].margin(x[400:]) * 3
    order = np.argsort(odds)
    assert (odds[order[[460, -460]]] * [-1, 1] > cotrain.SURE).all()
    want = {0.0: m[400:][order[:460]], 1.0: m[400:][order[-460:]]}
    for c, rows in want.items():
        got = Counter(r.tobytes() for r in gm[gl == c])
        assert got.total() == min(460, most // 2)
        # the same rows but for ties in the last step
        assert (got - Counter(r.tobytes() for r in rows)).total() <= 10


def test_views_do_not_depend_on_the_slice():
    texts = [PROSE, "", None, "A B! c", "x" * 5000, "é é é\n\n1 2"]
    whole = cotrain.text_view(next(ts.slices(pa.array(texts, pa.string()))))
    parts = np.vstack([cotrain.text_view(p) for p in ts.slices(pa.array(texts, pa.string()), 10)])
    assert np.allclose(whole, parts) and whole.shape == (6, cotrain.TEXT_WIDTH) and np.isfinite(whole).all()
    meta = cotrain.meta_view(["a", None, "a"], [None, "en", None], np.array([np.nan, 1e9, np.nan]))
    assert (meta[0] == meta[2]).all() and meta.sum(1).tolist() == [3, 3, 3]


@pytest.mark.parametrize("rows", [[], [(0, 1)], [(0, 1), (1, 1), (3, None)], [(99, 0), (0, 1)]])
def test_without_labels_of_both_kinds_all_are_kept(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    out = cotrain.judge(awkward(spark), labels).collect()
    assert len(out) == awkward(spark).count() and all(r["kept"] for r in out) and len({r["score"] for r in out}) == 1


def test_awkward_tables(spark):
    texts = [PROSE + f" {i}" if i % 2 else "@@ ## $$ %% " * (5 + i % 7) for i in range(80)]
    df = docs(spark, texts).union(awkward(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(5, 1), (None, 0)], "doc_id long, quality int")
    plain = cotrain.judge(df, labels).collect()
    assert len(plain) == df.count()
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in plain if r["doc_id"] is not None and r["doc_id"] < 80)
    assert sorted(map(repr, cotrain.judge(cluttered(df), cluttered(labels)).collect())) == sorted(map(repr, plain))
    assert cotrain.judge(df.limit(0), labels).count() == 0
