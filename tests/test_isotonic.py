"""Isotonic fits in many buckets against the max-min formula."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadspark.operators import isotonic as I


def max_min(n, pos):
    """The fit by definition."""
    cn, cp = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(pos)])
    k = len(n)
    mean = lambda a, b: (cp[b + 1] - cp[a]) / (cn[b + 1] - cn[a])
    return np.array([max(min(mean(a, b) for b in range(s, k)) for a in range(s + 1)) for s in range(k)])


def counts(spark, pos, n=None):
    n = np.ones(len(pos)) if n is None else n
    return spark.createDataFrame([(float(i), float(a), float(b)) for i, (a, b) in enumerate(zip(n, pos))], "s double, n double, pos double").repartition(5)


def fitted(pools, size):
    out = np.full(size, np.nan)
    for r in pools.collect():
        out[int(r["lo"]) : int(r["hi"]) + 1] = r["pos"] / r["n"]
    return out


def shapes():
    rng = np.random.default_rng(5)
    n = rng.integers(1, 9, 150).astype(float)
    return {
        "noise around a rise": (np.minimum(n, rng.binomial(n.astype(int), np.linspace(0.1, 0.9, 150))), n),
        "falls all the way, one pool": (np.linspace(1, 0, 150), np.ones(150)),
        "rises all the way, no pool": (np.linspace(0, 1, 150), np.ones(150)),
        "last one low": (np.append(np.full(149, 0.5), 0.0), np.ones(150)),
        "all equal": (np.full(150, 0.25), np.ones(150)),
    }


@pytest.mark.parametrize("shape", list(shapes()))
def test_many_buckets_give_the_max_min_fit(spark, shape):
    pos, n = shapes()[shape]
    pools = I.pools(counts(spark, pos, n), rows_per_bucket=3)  # fifty buckets
    np.testing.assert_allclose(fitted(pools, 150), max_min(n, pos), atol=1e-12)
    rows = sorted(pools.collect())
    assert all(a["hi"] < b["lo"] and a["pos"] / a["n"] < b["pos"] / b["n"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("rows_per_bucket", [4, 10**6])
def test_values_between_and_beyond_pools(spark, rows_per_bucket):
    pools = spark.createDataFrame([(1.0, 3.0, 2.0, 0.5), (5.0, 5.0, 1.0, 0.5), (8.0, 9.0, 4.0, 4.0)], I.POOL)
    x = [0.0, 1.0, 2.0, 3.0, 4.0, 4.5, 5.0, 6.5, 8.0, 8.5, 20.0, 4.0, None, float("nan")]
    df = spark.createDataFrame(list(enumerate(x)), "key long, x double")
    got = [r["y"] for r in I.interpolate(df, "x", pools, "y", rows_per_bucket).orderBy("key").collect()]
    assert got[:12] == pytest.approx([0.25, 0.25, 0.25, 0.25, 0.375, 0.4375, 0.5, 0.75, 1, 1, 1, 0.375])
    assert got[12:] == [None, None]


def test_no_scores(spark):
    assert I.pools(counts(spark, [])).collect() == []
    df = spark.createDataFrame([(1, 0.5)], "key long, x double")
    assert I.interpolate(df, "x", spark.createDataFrame([], I.POOL), "y").collect()[0]["y"] is None


def test_no_task_holds_more_than_its_bucket(spark):
    data = spark.range(20_000).select(F.col("id").cast("double").alias("s"), F.lit(1.0).alias("n"), (F.xxhash64("id") % 2 == 0).cast("double").alias("pos"))
    placed, _ = I.with_order_bucket(data.select(F.col("s").alias("lo")), F.col("lo"), F.col("lo"), 400)
    assert placed.groupBy("_bucket").count().agg(F.max("count")).first()[0] < 3 * 400
    assert I.pools(data, 400).agg(F.sum("n")).first()[0] == 20_000


def test_scores_are_looked_up_without_reading_a_bucket_anew_for_each_row(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, value = np.sort(rng.random(40)) * 2 - 0.5, np.sort(rng.random(40))
    pools = spark.createDataFrame([(float(a), float(a), 1.0, float(v)) for a, v in zip(x, value)], I.POOL)
    asked = rng.random(300) * 3 - 1
    df = spark.createDataFrame([(float(s),) for s in (*asked, *x)], "s double")
    found, lookup = [], I.lookup_join
    monkeypatch.setattr(I, "lookup_join", lambda left, right, *keys: found.append(right) or lookup(left, right, *keys))  # its plan is cut there
    for rows in (10, 1000):
        out = I.interpolate(df, "s", pools, "p", rows)
        plan = found.pop()._jdf.queryExecution().analyzed().toString().lower()
        assert "rangeframe" in plan and "unboundedfollowing" not in plan
        got = out.toPandas()
        np.testing.assert_allclose(got["p"], np.interp(got["s"], x, value), atol=1e-12)
