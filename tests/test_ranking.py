"""The distributed paths against brute force, with hot values and small buckets."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadspark.operators import ranking as R


def frame(spark, n=3000, hot=0.4, seed=0, levels=50):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, levels, n) / 10.0
    v[: int(n * hot)] = 1.7
    rng.shuffle(v)
    pdf = pd.DataFrame({"key": rng.permutation(n).astype("int64"), "v": v, "w": rng.integers(0, 5, n).astype("int64")})
    return pdf, spark.createDataFrame(pdf).repartition(7)


@pytest.mark.parametrize("rows_per_bucket", [10, 40, 700, 10**6])
def test_running_sums_and_rank(spark, rows_per_bucket):
    pdf, df = frame(spark)
    got = R.running_sums(df, F.col("v"), F.col("key"), {"rank": F.lit(1).cast("long"), "cum": F.col("w")}, rows_per_bucket).toPandas()
    want = pdf.sort_values(["v", "key"]).reset_index(drop=True)
    want["rank"] = np.arange(1, len(want) + 1)
    want["cum"] = want["w"].cumsum()
    pd.testing.assert_frame_equal(got.sort_values("rank").reset_index(drop=True)[["key", "v", "w", "rank", "cum"]], want, check_dtype=False)


def test_hot_value_is_split_along_the_key(spark):
    _, df = frame(spark, n=20_000, hot=0.4)
    bucketed, m = R.with_order_bucket(df, F.col("v"), F.col("key"), rows_per_bucket=200)
    sizes = bucketed.groupBy("_bucket").count().toPandas()["count"]
    assert m == 100 and sizes.max() < 20_000 * 0.05


def test_hot_value_tied_to_the_key_is_split_too(spark):
    df = spark.range(20_000).select(F.col("id").alias("key"), F.when(F.col("id") < 8000, 0.5).otherwise(F.col("id") / 100.0).alias("v"))
    bucketed, _ = R.with_order_bucket(df, F.col("v"), F.col("key"), rows_per_bucket=200)
    assert bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0] < 1000


def test_negative_zero_and_all_equal(spark):
    df = spark.createDataFrame([(i, 0.0 if i % 2 else -0.0) for i in range(500)], "key long, v double")
    got = R.with_rank(df, -F.col("v"), F.col("key"), rows_per_bucket=10).orderBy("rank").toPandas()
    assert got["key"].tolist() == list(range(500)) and got["rank"].tolist() == list(range(1, 501))


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "key long, v double")
    assert R.with_rank(empty, F.col("v"), F.col("key")).count() == 0
    one = spark.createDataFrame([(1, 0.3)], "key long, v double")
    assert R.rank_leads(one, "v", "key").select("rank", "decile").collect() == [(1, 1)]


def test_input_order_does_not_matter(spark):
    _, df = frame(spark, n=500)
    a = R.with_rank(df, -F.col("v"), F.col("key"), rows_per_bucket=30).orderBy("key").collect()
    b = R.with_rank(df.orderBy(F.rand(3)), -F.col("v"), F.col("key"), rows_per_bucket=30).orderBy("key").collect()
    assert a == b


@pytest.mark.parametrize("n", [1, 2, 7, 10, 101, 1235])
def test_quantile_groups_follow_linear_edges(spark, n):
    got = spark.range(1, n + 1).select(R.quantile_group(F.col("id"), n, 10).alias("g")).toPandas()["g"].tolist()
    want = [1] if n == 1 else [max(1, -(-(r * 10) // (n - 1))) for r in range(n)]
    assert got == want


@pytest.mark.parametrize("rows_per_bucket", [17, 10**6])
def test_average_rank(spark, rows_per_bucket):
    pdf, df = frame(spark, n=800)
    got = R.average_rank_share(df, "v", rows_per_bucket=rows_per_bucket).toPandas().sort_values("key")
    want = (pdf["v"].rank(method="average") / len(pdf)).set_axis(pdf["key"]).sort_index()
    np.testing.assert_allclose(got["p_rank"].to_numpy(), want.to_numpy())


@pytest.mark.parametrize("rows_per_bucket", [25, 10**6])
def test_hash_rank_is_a_permutation_per_group(spark, rows_per_bucket):
    _, df = frame(spark, n=1000)
    got = R.hash_ranked(df, F.col("key"), 3, ["w"], rows_per_bucket).toPandas()
    for _, part in got.groupby("w"):
        assert sorted(part["hash_rank"]) == list(range(1, len(part) + 1))
    base = R.hash_ranked(df, F.col("key"), 3, ["w"], 10**6).toPandas()
    assert got.sort_values("key")["hash_rank"].tolist() == base.sort_values("key")["hash_rank"].tolist()


def test_quota_is_exact_also_for_a_hot_group(spark):
    df = spark.range(30_000).withColumn("g", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7 + 1))
    sizes = {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    quotas = {0: 12345, 1: 0, 2: 1, 3: 10**6, 4: 77}
    table = spark.createDataFrame(list(quotas.items()), "g long, quota long")
    got = R.hash_quota(df, F.col("id"), 9, ["g"], table).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in got} == {g: min(q, sizes[g]) for g, q in quotas.items() if q}


def test_random_rows(spark):
    df = spark.range(5000)
    a = {r[0] for r in R.random_rows(df, F.col("id"), 123).collect()}
    b = {r[0] for r in R.random_rows(df.repartition(13), F.col("id"), 123).collect()}
    assert len(a) == 123 and a == b
    assert R.random_rows(df, F.col("id"), 9999).count() == 5000 and R.random_rows(df, F.col("id"), 0).count() == 0


@pytest.mark.parametrize("max_distinct", [0, 10**6])
def test_exact_quantiles_both_ways(spark, max_distinct):
    pdf, df = frame(spark, n=777)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = R.exact_quantiles(df.withColumn("none", F.lit(None).cast("double")), ["v", "w", "none"], probs, max_distinct, 50)
    np.testing.assert_allclose(got["v"], np.quantile(pdf["v"], probs))
    np.testing.assert_allclose(got["w"], np.quantile(pdf["w"], probs))
    assert got["none"] == [None] * len(probs)


def test_ordered_index(spark):
    words = [f"w{i % 300:03d}" for i in range(900)]
    df = spark.createDataFrame([(w,) for w in words], "value string").distinct()
    got = {r["value"]: r["code"] for r in R.ordered_index(df, "value", "code").collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words)))}


def test_constant_key_still_gives_many_buckets(spark):
    """Distinct scores with one key for all, drawn at a share far below one."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("score"), F.lit(1).alias("c"))
    placed, aimed = R.with_order_bucket(df, F.col("score"), F.lit(0), rows_per_bucket=4_000)
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert R.SAMPLE_PER_BUCKET * aimed / 200_000 < 0.1
    assert len(sizes) >= 50 and max(sizes) < 4 * 4_000
    sums = R.running_sums(df, F.col("score"), F.lit(0), {"upto": F.col("c")}, rows_per_bucket=4_000)
    order = sums.select("score", "upto").orderBy("score").toPandas()
    assert (order["upto"].to_numpy() == range(1, 200_001)).all()


@pytest.mark.parametrize("rows_per_bucket", [500_000, 2])
def test_rows_without_a_score_are_left_out(spark, rows_per_bucket):
    from leadspark.operators import metrics as M

    rows = [(1, 1, 0.9), (2, 0, 0.5), (3, 0, None), (4, 1, float("nan")), (5, 1, 0.4), (6, 0, 0.1), (7, 0, 0.05)]
    df = spark.createDataFrame(rows, "company_id long, target int, score double")
    clean = df.where("score IS NOT NULL AND NOT isnan(score)")
    for f in (M.average_precision, M.auc, M.pr_curve, M.roc_curve):
        assert sorted(map(repr, f(df, rows_per_bucket=rows_per_bucket).collect())) == sorted(map(repr, f(clean, rows_per_bucket=500_000).collect()))
    ranks = {r["company_id"]: r["rank"] for r in R.rank_leads(df, "score", rows_per_bucket=rows_per_bucket).collect()}
    assert ranks == {1: 1, 2: 2, 5: 3, 6: 4, 7: 5}
    share = {r["company_id"]: r["p_rank"] for r in R.average_rank_share(df, "score", rows_per_bucket=rows_per_bucket).collect()}
    assert share[3] is None and share[1] == 1.0


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_values_that_are_not_finite_are_left_out_whatever_the_number_of_buckets(spark, rows_per_bucket):
    values = [None, float("nan"), float("inf"), float("-inf")] + [i / 7 for i in range(60)]
    df = spark.createDataFrame(list(enumerate(values)), "key long, v double")
    got = R.with_rank(df, -F.col("v"), F.col("key"), rows_per_bucket=rows_per_bucket).orderBy("rank").toPandas()
    assert got["key"].tolist() == list(range(63, 3, -1)) and got["rank"].tolist() == list(range(1, 61))
    assert [r["key"] for r in R.top_k(df, "v", "key", 2).collect()] == [63, 62]


@pytest.mark.parametrize("keep, accuracy", [(2_000, 4_096), (20, 200)])
def test_quantiles_of_awkward_columns_in_rounds(spark, keep, accuracy):
    rng = np.random.default_rng(2)
    n = 1_001
    cols = {
        "heavy tail": np.exp(rng.normal(0, 60, n)),
        "two values": np.where(np.arange(n) < 500, 1.0, 2.0),
        "hot value": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
        "constant": np.full(n, -3.0),
        "all different": rng.permutation(n) / 7,
        "infinite ends": np.concatenate([[-np.inf] * 3, rng.normal(size=n - 6), [np.inf] * 3]),
    }
    pdf = pd.DataFrame({c: rng.permutation(v) for c, v in cols.items()})
    holed = pdf.mask(rng.random(pdf.shape) < 0.1)
    probs = [0.0, 0.25, 0.5, 0.999]
    got = R.exact_quantiles(spark.createDataFrame(holed).repartition(5), list(cols), probs, keep, accuracy)
    for c in cols:
        v = np.sort(holed[c].dropna().to_numpy())
        x = np.array(probs) * (len(v) - 1)
        lo, hi = v[np.floor(x).astype(int)], v[np.ceil(x).astype(int)]
        want = [a if a == b else a + (b - a) * (y - np.floor(y)) for a, b, y in zip(lo, hi, x)]
        np.testing.assert_allclose(got[c], want, rtol=1e-12, err_msg=c)


def test_quantiles_are_exact_from_sampled_sketches(spark, monkeypatch):
    monkeypatch.setattr(R, "SKETCHED", 300)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": np.exp(rng.normal(size=30_000) * 3), "y": rng.integers(0, 4, 30_000).astype(float)})
    got = R.exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], [0.01, 0.5, 0.99], keep=50)
    for c in ("x", "y"):
        np.testing.assert_allclose(got[c], np.quantile(pdf[c], [0.01, 0.5, 0.99]))


@pytest.mark.parametrize("bits, edge_rows", [((2, 2, 2, 26), 10), ((4, 28), 0)])
def test_quotas_are_exact_when_slices_are_refined(spark, bits, edge_rows):
    rows = [(i, "hot" if i % 3 else f"g{i % 5}") for i in range(4_000)]
    df = spark.createDataFrame(rows, "key long, g string")
    quotas = spark.createDataFrame([("hot", 1_234), ("g0", 0), ("g1", 10**6), ("g2", 1)], "g string, quota long")
    got = R.hash_quota(df, F.col("key"), 5, ["g"], quotas, bits, edge_rows)
    ranked = R.hash_ranked(df, F.col("key"), 5, ["g"]).join(quotas, "g").where("hash_rank <= quota").select("key", "g")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ranked.collect()))
    one = {r["key"] for r in R.hash_quota(df, F.col("key"), 5, [], 777, bits, edge_rows).collect()}
    assert one == {r["key"] for r in R.hash_ranked(df, F.col("key"), 5, []).where("hash_rank <= 777").collect()}
    base = df.withColumns({"_h": R.hash32(F.col("key"), 5), "_key": F.col("key")})
    assert R._quota_cuts(base, ["g"], quotas, (2, 2, 2, 2, 24), 20).agg(F.max("_edge")).first()[0] <= 20
