import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadspark.operators import box_search as B
from leadspark.operators import lookalike as K
from leadspark.operators import metric_index as MI


def points(spark, n=400, d=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0]  # a third of all rows are copies
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_key long, v array<double>")


def brute(q, x, k, exclude_self=False):
    d = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    if exclude_self:
        np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("kw", [{}, dict(broadcast_values=0, block_rows=23, query_rows=57)])
def test_nearest_is_exact(spark, exclude_self, kw):
    x, df = points(spark)
    got = K.nearest(df, df, "v", "row_key", "row_key", 7, exclude_self, **kw).toPandas().sort_values("row_key")
    np.testing.assert_allclose(np.array(got["distances"].tolist()), brute(x, x, 7, exclude_self), atol=1e-7)
    if exclude_self:
        assert all(k not in ids for k, ids in zip(got["row_key"], got["neighbour_ids"]))


def test_fewer_rows_than_k(spark):
    _, df = points(spark, 12)
    for kw in ({}, dict(broadcast_values=0, block_rows=5, query_rows=4)):
        got = K.nearest(df, df.where("row_key < 3"), "v", "row_key", "row_key", 7, **kw).toPandas()
        assert len(got) == 12 and {len(d) for d in got["distances"]} == {3}


def test_limited_probes_never_beat_the_exact_search(spark):
    x, df = points(spark, 600, 4)
    got = K.nearest(df, df, "v", "row_key", "row_key", 5, probes=3).toPandas().sort_values("row_key")
    exact = brute(x, x, 5)
    for d, e in zip(got["distances"], exact):
        assert all(a >= b - 1e-7 for a, b in zip(sorted(d), e))


def test_distance_features(spark):
    x, df = points(spark, 60)
    out = K.distance_features(df, df.where("row_key < 30"), "v", "row_key", 5).toPandas().sort_values("row_key")
    d = brute(x, x[:30], 5)
    for c, want in zip(K.DISTANCE_FEATURES, (d.mean(axis=1), d.min(axis=1), d.max(axis=1), d.std(axis=1))):
        np.testing.assert_allclose(out[c], want, atol=1e-6)
    few = K.distance_features(df, df.where("row_key < 4"), "v", "row_key", 5)
    assert few.where(" or ".join(f"{c} <> 0" for c in K.DISTANCE_FEATURES)).count() == 0


def mixed(spark, n=200):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 2, n)
    pdf = pd.DataFrame(
        {"row_key": np.arange(n, dtype="int64"), "a": g * 8 + rng.normal(size=n), "b": rng.normal(size=n), "c": np.where(g == 1, "x", "y"), "target": ((g == 1) & (rng.random(n) < 0.6)).astype(int)}
    )
    return pdf, spark.createDataFrame(pdf)


def test_clusters_separate_groups(spark):
    pdf, df = mixed(spark)
    model = K.fit_cluster_rates(df, ["a", "b"], ["c"], k=2, n_init=2, max_iter=10)
    out = model.transform(df).toPandas()
    assert out.groupby("c")["cluster_id"].nunique().tolist() == [1, 1]
    rate = out.groupby("c")["cluster_conversion_rate"].first()
    n, pos, all_rate = (pdf["c"] == "x").sum(), pdf["target"].sum(), pdf["target"].mean()
    assert rate["x"] == pytest.approx((pos + all_rate * 15) / (n + 15)) and rate["y"] < rate["x"]


def test_unfitted_clusters_are_neutral(spark):
    _, df = mixed(spark, 10)
    out = K.ClusterRateModel(None, {}, {}, 0.25).transform(df).select("cluster_id", "cluster_conversion_rate").distinct().collect()
    assert [tuple(r) for r in out] == [(0, 0.25)]


def test_unknown_category_and_null_are_assigned(spark):
    _, df = mixed(spark)
    model = K.fit_cluster_rates(df, ["a", "b"], ["c"], k=2, n_init=1, max_iter=5)
    new = spark.createDataFrame([(1, None, None, None), (2, 9.0, 0.0, "never")], "row_key long, a double, b double, c string")
    assert model.transform(new).where("cluster_conversion_rate is not null").count() == 2


def test_combined_features(spark):
    _, df = mixed(spark)
    frames = K.add_lookalike_features(df, {"val": df.where("row_key < 20")}, numeric=["a", "b"], categorical=["c"], n_clusters=3, n_neighbors=5, n_init=1, max_iter=5)
    want = {"cluster_id", "cluster_conversion_rate", *K.DISTANCE_FEATURES}
    assert want <= set(frames["train"].columns) and frames["train"].count() == 200 and frames["val"].count() == 20
    own = frames["train"].where(F.col("target") == 1).agg(F.max("min_dist_converter")).first()[0]
    assert own == pytest.approx(0)


def test_cell_rule():
    assert [K.cell_count(n) for n in (5, 100, 400, 10**6)] == [10, 10, 20, 100]
    assert K.probe_count(100) == 10 and K.probe_count(4) == 4


def clustered(spark, n, groups, d=6, seed=3):
    """Points around ``groups`` places, as many to a place whatever n."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, d))[rng.integers(0, groups, n)] * 20 + rng.normal(size=(n, d))
    return x, spark.createDataFrame(pd.DataFrame({"row_key": np.arange(n), "v": x.tolist()}))


def test_distances_per_query_grow_far_slower_than_the_index(spark):
    q = 100
    per_query = {}
    for n in (1_000, 16_000):
        x, df = clustered(spark, n, n // 100)
        work = spark.sparkContext.accumulator(0)
        got = K.nearest(df.where(F.col("row_key") < q), df, "v", "row_key", "row_key", 5, broadcast_values=0, block_rows=500, work=work).toPandas().sort_values("row_key")
        np.testing.assert_allclose(np.array(got["distances"].tolist()), brute(x[:q], x, 5), atol=1e-9)
        per_query[n] = work.value / q
    # sixteen times the rows: with the square root of them four times the distances, all of them would be sixteen times
    assert per_query[16_000] < 6 * per_query[1_000] and per_query[16_000] < 16_000 / 8


def test_hot_cell_is_split_and_ties_go_to_the_lower_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 0.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "row_key long, v array<double>")
    got = K.nearest(df.where("row_key >= 290"), df, "v", "row_key", "row_key", 4, broadcast_values=0, block_rows=50, query_rows=20).toPandas().sort_values("row_key")
    want = K.nearest(df.where("row_key >= 290"), df, "v", "row_key", "row_key", 4).toPandas().sort_values("row_key")
    assert [list(r) for r in got["neighbour_ids"]] == [list(r) for r in want["neighbour_ids"]]
    assert list(got["neighbour_ids"].iloc[0]) == [0, 1, 2, 3]
    index = MI.MetricIndex(df.select(F.col("row_key").alias("_i"), F.col("v").alias("_x")), 340, 2, 4, block_rows=50)
    parts = dict(enumerate(index.parts.tolist()))
    largest = max(r["n"] / parts[r["_unit"]] for r in index.rows.groupBy("_unit").agg(F.count(F.lit(1)).alias("n")).collect())
    assert largest <= 50


def test_index_cells_grow_with_the_square_root_up_to_the_bound():
    assert [MI.index_cells(n, 64) for n in (0, 100, 10**6, 10**10, 10**12)] == [1, 10, 1000, 62_500, 62_500]


@pytest.mark.parametrize("width", [1, 3, 7])
def test_boxes_find_the_nearest_rows_with_few_distances(width):
    rng = np.random.default_rng(width)
    x, q = rng.normal(size=(20_000, width)), rng.normal(size=(2_000, width))
    x[:5_000] = x[:100].repeat(50, axis=0)  # copies
    q[0], q[1] = x[0], np.nan
    ids = rng.permutation(len(x))
    d, i, work = B.BoxIndex(*B.few_copies(x, ids, 5)).nearest(q, 5)
    for r in (0, *range(2, 200)):
        all_d = np.sqrt(((x - q[r]) ** 2).sum(axis=1))
        order = np.lexsort((ids, all_d))[:5]
        assert d[r].tolist() == all_d[order].tolist() and i[r].tolist() == ids[order].tolist()
    assert np.isinf(d[1]).all()
    if width < 7:
        assert work < len(q) * len(x) / 8


def test_search_by_broadcast_is_spread_over_tasks_and_leaves_own_entries_out(spark):
    rows = [(i, [float(i % 40), 0.0]) for i in range(400)]
    df = spark.createDataFrame(rows + rows[:3], "row_key long, v array<double>").coalesce(1)  # keys repeat
    found = K.nearest(df, df, "v", "row_key", "row_key", 12, exclude_self=True, query_rows=30)
    assert found.rdd.getNumPartitions() == 14
    got = {r["row_key"]: (list(r["distances"]), list(r["neighbour_ids"])) for r in found.collect()}
    assert found.count() == 403
    for key in (0, 1, 3, 45, 399):
        pairs = sorted((abs(v[0] - key % 40), i) for i, v in rows + rows[:3] if i != key)[:12]
        assert got[key] == ([p[0] for p in pairs], [p[1] for p in pairs])


def test_cells_find_all_neighbours_in_a_session_without_arrow(spark):
    """Frames made of pandas rows have other types there; keys of both sides must agree all the same."""
    x, df = points(spark, 900, 9)
    held = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        got = K.nearest(df, df.where("row_key % 2 = 0"), "v", "row_key", "row_key", 6, broadcast_values=0, block_rows=16, query_rows=40).orderBy("row_key").collect()
        mean = K.distance_features(df, df.where("row_key % 2 = 0"), "v", "row_key", 6, broadcast_values=0, block_rows=16, query_rows=40)
        assert mean.where("mean_dist_converters IS NOT NULL").count() == 900
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", held)
    np.testing.assert_allclose(np.array([r["distances"] for r in got]), brute(x, x[::2], 6), atol=1e-9)


@pytest.mark.parametrize("kw", [{}, dict(broadcast_values=0, block_rows=16)])
def test_rows_without_a_vector_are_no_neighbours_and_have_none(spark, kw):
    rows = [(i, [float(i)] * 9) for i in range(30)] + [(30, None), (31, [float("nan")] * 9)]
    df = spark.createDataFrame(rows, "row_key long, v array<float>")
    got = {r["row_key"]: list(r["neighbour_ids"]) for r in K.nearest(df, df, "v", "row_key", "row_key", 2, **kw).collect()}
    assert len(got) == 32 and got[30] == got[31] == [] and got[5] == [5, 4] and got[29] == [29, 28]
    assert K.distance_features(df, df, "v", "row_key", 2, **kw).where("mean_dist_converters IS NULL").count() == 2


def test_a_query_is_moved_once_for_many_small_blocks(spark):
    """Visits grow with shelves, not with blocks of ``block_rows`` rows, and nothing is lost where nearly all rows must be compared."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3_000, 24))
    df = spark.createDataFrame(pd.DataFrame({"_i": np.arange(3_000), "_x": x.tolist()}))
    index = MI.MetricIndex(df, 3_000, 24, 4, block_rows=16, query_rows=128)
    qs = df.select(F.col("_i").alias("_q"), F.col("_x").alias("_y")).where("_q < 500")
    assert index.parts.sum() >= 3_000 / 16
    seeded = index._seeds(qs, 4)
    assert index._first_visits(seeded).count() + index._visits(seeded).count() <= 2 * 500
    got = index.search(qs).orderBy("_q").toPandas()
    np.testing.assert_allclose(np.array(got["distances"].tolist()), brute(x[:500], x, 4), atol=1e-9)


def test_units_stand_side_by_side_on_shelves():
    got = MI._shelves(np.array([1, 1, 5, 1]), np.array([30, 60, 200, 10]), 100)
    assert got.to_numpy().tolist() == [[0, 0, 1, 3], [0, 0, 1, 1], [1, 3, 2, 2], [3, 3, 1, 10]]


@pytest.mark.parametrize("copies", [1, 400])
def test_a_shelf_finds_the_nearest_rows_and_breaks_ties_by_id(copies):
    rng = np.random.default_rng(copies)
    x = np.repeat(rng.normal(size=(1_200 // copies if copies > 1 else 1_200, 10)), copies, axis=0)
    ids, y = rng.permutation(len(x)), rng.normal(size=(300, 10))
    d, i, work = K._shelf(x, ids, 5).nearest(y, np.full(300, np.inf), 5)
    assert work > 0
    for r in range(300):
        all_d = np.sqrt(((x - y[r]) ** 2).sum(axis=1))
        order = np.lexsort((ids, all_d))[:5]
        assert d[r].tolist() == all_d[order].tolist() and i[r].tolist() == ids[order].tolist()


def test_one_pass_gives_means_and_modes_of_every_start(spark, monkeypatch):
    monkeypatch.setattr(K, "PACK_ROWS", 30)  # several blocks a task
    pdf, df = mixed(spark)
    start = K.fit_prototypes(df, ["a", "b"], ["c"], "row_key", 3, 1, max_iter=0)
    got = K.fit_prototypes(df, ["a", "b"], ["c"], "row_key", 3, 1, max_iter=1)
    marked = K.assign_clusters(df, start).toPandas().groupby("cluster_id")
    np.testing.assert_allclose(np.array(got.centers), marked[["a", "b"]].mean().to_numpy(), atol=1e-9)
    assert [m[0] for m in got.modes] == [max(g["c"].unique(), key=lambda v: ((g["c"] == v).sum(), v)) for _, g in marked]
    costs = []
    for i in (1, 3):
        p = K.fit_prototypes(df, ["a", "b"], ["c"], "row_key", 4, i)
        costs.append(df.agg(F.sum(K.assignment(p)["cost"])).first()[0])
    assert costs[1] <= costs[0] + 1e-9


def test_combined_query_fits_as_many_clusters_starts_and_steps_as_the_library(spark, sf, monkeypatch):
    from leadspark.plans import q_lookalike

    seen, fit = [], K.fit_prototypes
    monkeypatch.setattr(K, "fit_prototypes", lambda *args: seen.append(args) or fit(*args))
    out = q_lookalike.lk_combined(spark, sf)
    assert [a[4:7] for a in seen] == [(K.N_CLUSTERS, 3, 100)]
    assert out.select("cluster_id").distinct().count() > 8
