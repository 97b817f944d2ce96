"""Look-alike features: mixed-type clusters with conversion rates, and distances to known converters."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, Accumulator, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadspark.functions.features import or_missing
from leadspark.functions.hashing import SPACE, hash32
from leadspark.operators.box_search import NARROW, BoxIndex, few_copies, halves, without_own
from leadspark.operators.encoders import standardize
from leadspark.operators.metric_index import BLOCK_ROWS, NEAR_SCHEMA, QUERY_ROWS, MetricIndex, Shelf, top_k, vectors
from leadspark.schema import autodetect_roles
from leadspark.session import cut

# Cluster count and prior weight, neighbours, and the rule for the number of coarse cells.
N_CLUSTERS = 20
PRIOR_WEIGHT = 15
N_NEIGHBORS = 20
MIN_CELLS = 10
MAX_CELLS = 100
MAX_PROBES = 10

BROADCAST_VALUES = 4_000_000


# ---- clusters of mixed columns ------------------------------------------------------------------


@dataclass(frozen=True)
class Prototypes:
    """k centres: means of the numeric columns and most frequent categories."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    centers: tuple[tuple[float, ...], ...]
    modes: tuple[tuple[str, ...], ...]
    gamma: float

    @property
    def k(self) -> int:
        return len(self.centers)


def assignment(p: Prototypes) -> Column:
    """(cost, cluster) of the nearest prototype: squared distance plus gamma per differing category."""
    options = []
    for j in range(p.k):
        cost: Column = F.lit(0.0)
        for c, m in zip(p.numeric, p.centers[j]):
            d = F.col(c) - F.lit(float(m))
            cost = cost + d * d
        for c, m in zip(p.categorical, p.modes[j]):
            cost = cost + F.when(F.col(c) == F.lit(m), 0.0).otherwise(p.gamma)
        options.append(F.struct(cost.alias("cost"), F.lit(j).alias("cluster")))
    return F.array_min(F.array(*options))


def assign_clusters(df: DataFrame, p: Prototypes, out: str = "cluster_id") -> DataFrame:
    return df.withColumn(out, assignment(p)["cluster"])


#: Rows whose numbers and categories are moved together.
PACK_ROWS = 50_000
STEP_ROWS = 3_000


def _packed(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The rows as few blocks of bytes: numbers, and categories as places in the block's own lists."""

    def pack(batches):
        part = TaskContext.get().partitionId()
        for at, b in enumerate(_gathered(batches, PACK_ROWS)):
            x = b[numeric].to_numpy(dtype=float).reshape(len(b), len(numeric))
            coded = [pd.factorize(b[c]) for c in categorical]
            codes = np.array([c for c, _ in coded], np.int32).reshape(len(categorical), len(b))
            yield pd.DataFrame({"block": [part * 2**32 + at], "n": [len(b)], "x": [x.tobytes()], "codes": [codes.tobytes()], "labels": [[list(v) for _, v in coded]]})

    return df.mapInPandas(pack, "block long, n long, x binary, codes binary, labels array<array<string>>")


def _block_stats(block, ps: dict[int, Prototypes]):
    """Of one block, for each start: sums of each cluster, and how often it has each category."""
    x, codes = np.frombuffer(block["x"]).reshape(block["n"], -1), np.frombuffer(block["codes"], np.int32).reshape(-1, block["n"])
    for start, p in ps.items():
        centers = np.array(p.centers).reshape(p.k, len(p.numeric))
        differ = [np.where(np.array(labels, object)[:, None] == np.array([m[j] for m in p.modes], object)[None, :], 0.0, p.gamma) for j, labels in enumerate(block["labels"])]
        cluster, least = np.empty(len(x), np.int64), np.empty(len(x))
        for s in range(0, len(x), STEP_ROWS):
            cost = np.zeros((len(x[s : s + STEP_ROWS]), p.k))
            for j in range(len(p.numeric)):
                d = x[s : s + STEP_ROWS, j, None] - centers[None, :, j]
                cost += d * d
            for code, table in zip(codes, differ):
                cost += table[code[s : s + STEP_ROWS]]
            cluster[s : s + STEP_ROWS], least[s : s + STEP_ROWS] = cost.argmin(axis=1), cost.min(axis=1)
        known = np.isfinite(x)
        sums = [np.bincount(cluster, np.nan_to_num(least), p.k)]
        for j in range(len(p.numeric)):
            sums += [np.bincount(cluster, np.where(known[:, j], x[:, j], 0.0), p.k), np.bincount(cluster, known[:, j], p.k)]
        for c in np.unique(cluster).tolist():
            yield (start, c, -1, ""), [(block["block"], tuple(float(v[c]) for v in sums))]
        for j, (code, labels) in enumerate(zip(codes, block["labels"])):
            counts = np.bincount(cluster * len(labels) + code, minlength=p.k * len(labels))
            for at in np.flatnonzero(counts).tolist():
                yield (start, at // len(labels), j, labels[at % len(labels)]), int(counts[at])


def _update(blocks: RDD, ps: dict[int, Prototypes]) -> dict[int, tuple[Prototypes, float]]:
    """Means and modes of the clusters of each start, in one pass, and the cost of what they were. An empty cluster keeps its prototype."""

    def whole(item):
        (start, cluster, column, value), got = item
        if column >= 0:
            return (start, cluster, column), (got, value)
        return (start, cluster, column), tuple(map(sum, zip(*(v for _, v in sorted(got)))))  # in the blocks' order: the same sums each time

    parts = blocks.context.defaultParallelism
    stats = blocks.flatMap(lambda b: _block_stats(b, ps)).reduceByKey(lambda a, b: a + b, parts).map(whole).reduceByKey(max, parts).collect()  # k x (1 + columns) a start
    centers, modes, costs = {s: [list(c) for c in p.centers] for s, p in ps.items()}, {s: [list(m) for m in p.modes] for s, p in ps.items()}, dict.fromkeys(ps, 0.0)
    for (start, cluster, column), got in sorted(stats, key=lambda r: r[0]):
        if column >= 0:
            modes[start][cluster][column] = got[1]
            continue
        costs[start] += got[0]
        for j, (total, n) in enumerate(zip(got[1::2], got[2::2])):
            if n:
                centers[start][cluster][j] = total / n
    return {s: (Prototypes(p.numeric, p.categorical, tuple(map(tuple, centers[s])), tuple(map(tuple, modes[s])), p.gamma), costs[s]) for s, p in ps.items()}


def fit_prototypes(
    df: DataFrame, numeric: list[str], categorical: list[str], key: str, k: int = N_CLUSTERS, n_init: int = 3, max_iter: int = 100, seed: int = 42
) -> Prototypes:
    """k-prototypes (Huang 1998) on standardised numbers and text categories.

    The driver keeps k centres a start; each step is one pass over rows stored in
    blocks, for all starts that still move.
    """
    prepared = cut(df.select(key, *[F.col(c).cast("double").alias(c) for c in numeric], *[or_missing(F.col(c)).alias(c) for c in categorical]), spread=True)
    spread = prepared.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first() if numeric else []
    gamma = 0.5 * float(np.mean([s or 0.0 for s in spread])) if numeric else 1.0
    ps, costs = {}, {}
    for start in range(n_init):
        first = prepared.orderBy(hash32(F.col(key), seed + start), key).limit(k).collect()  # k rows
        centers, modes = tuple(tuple(float(r[c]) for c in numeric) for r in first), tuple(tuple(r[c] for c in categorical) for r in first)
        ps[start], costs[start] = Prototypes(tuple(numeric), tuple(categorical), centers, modes, gamma), float("inf")
    blocks = cut(_packed(prepared, numeric, categorical)).rdd
    moving = set(ps)
    for _ in range(max_iter):
        for start, (moved, new_cost) in _update(blocks, {s: ps[s] for s in moving}).items() if moving else ():
            if new_cost >= costs[start]:  # the cost is that of ``ps[start]``
                moving.discard(start)
                continue
            costs[start] = new_cost
            if moved == ps[start]:
                moving.discard(start)
            ps[start] = moved
    return ps[min(ps, key=lambda s: (costs[s], s))]


def cluster_rates(df: DataFrame, target: str = "target", cluster: str = "cluster_id", prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """(cluster, rate): conversion rate drawn to the overall rate by a prior of ``prior_weight`` rows."""
    total = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    return df.groupBy(cluster).agg(
        ((F.sum(F.col(target).cast("double")) + F.lit(float(total or 0.0)) * prior_weight) / (F.count(F.lit(1)) + prior_weight)).alias("rate")
    )


@dataclass(frozen=True)
class ClusterRateModel:
    prototypes: Prototypes | None
    stats: dict
    rates: dict
    overall: float

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``cluster_id`` and ``cluster_conversion_rate``; unfitted: cluster 0 and the overall rate."""
        if self.prototypes is None:
            return df.withColumns({"cluster_conversion_rate": F.lit(self.overall), "cluster_id": F.lit(0)})
        p = self.prototypes
        ready, _ = standardize(df.select("*", *[F.col(c).alias(f"_n_{c}") for c in p.numeric]), [f"_n_{c}" for c in p.numeric], {f"_n_{c}": v for c, v in self.stats.items()})
        ready = ready.withColumns({f"_c_{c}": or_missing(F.col(c)) for c in p.categorical})
        local = Prototypes(tuple(f"_n_{c}" for c in p.numeric), tuple(f"_c_{c}" for c in p.categorical), p.centers, p.modes, p.gamma)
        rate = F.create_map(*[F.lit(x) for c, r in self.rates.items() for x in (int(c), float(r))])
        out = assign_clusters(ready, local)
        out = out.withColumn("cluster_conversion_rate", F.coalesce(F.element_at(rate, F.col("cluster_id")), F.lit(self.overall)))
        return out.drop(*local.numeric, *local.categorical)


def fit_cluster_rates(
    df: DataFrame, numeric: list[str], categorical: list[str], target: str = "target", key: str = "row_key", k: int = N_CLUSTERS, n_init: int = 3,
    max_iter: int = 100, prior_weight: float = PRIOR_WEIGHT, seed: int = 42,
) -> ClusterRateModel:
    """Prototypes on the training rows and the smoothed rate of each of the k clusters."""
    if not numeric and not categorical:
        raise ValueError("no columns to cluster on")
    scaled, stats = standardize(df.select(key, target, *numeric, *categorical), numeric) if numeric else (df, {})
    p = fit_prototypes(scaled, numeric, categorical, key, k, n_init, max_iter, seed)
    marked = assign_clusters(scaled.withColumns({c: or_missing(F.col(c)) for c in categorical}), p).select("cluster_id", target)
    rates = {r["cluster_id"]: r["rate"] for r in cluster_rates(marked, target, prior_weight=prior_weight).collect()}  # k rows
    overall = df.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0
    return ClusterRateModel(p, {c: tuple(v) for c, v in stats.items()}, rates, float(overall))


# ---- exact nearest neighbours -------------------------------------------------------------------


def cell_count(n: int) -> int:
    """Coarse cells for n indexed rows."""
    return min(MAX_CELLS, max(MIN_CELLS, int(n**0.5)))


def probe_count(cells: int) -> int:
    """Cells an approximate search visits."""
    return min(MAX_PROBES, cells)


def _result(keys, d: np.ndarray, i: np.ndarray) -> pd.DataFrame:
    ok = np.isfinite(d)
    return pd.DataFrame({"_q": keys, "distances": [r[m] for r, m in zip(d, ok)], "neighbour_ids": [r[m] for r, m in zip(i, ok)]})


def _results(keys, d: np.ndarray, i: np.ndarray, step: int = 10_000):
    for at in range(0, len(d), step):
        yield _result(keys[at : at + step], d[at : at + step], i[at : at + step])


def _gathered(batches, rows: int):
    """Batches put together up to ``rows`` rows, so that many queries lie near each other."""
    held, n = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def nearest(
    queries: DataFrame,
    index: DataFrame,
    vector: str,
    query_key: str,
    index_key: str,
    k: int = N_NEIGHBORS,
    exclude_self: bool = False,
    broadcast_values: int = BROADCAST_VALUES,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    probes: int | None = None,
    work: Accumulator | None = None,
) -> DataFrame:
    """(query key, distances, neighbour_ids): the k nearest indexed rows of every query.

    Exact unless ``probes`` limits the search to that many nearest of the coarse
    cells. An index whose values fit ``broadcast_values`` goes to every task; a
    larger one is searched by :class:`MetricIndex`. ``work`` counts the distances
    that its queries take. Rows that are null or not finite are no neighbours and
    have none.
    """
    idx = index.select(F.col(index_key).cast("long").alias("_i"), _numbers(index, vector, probes).alias("_x"))
    qs = queries.select(F.col(query_key).cast("long").alias("_q"), _numbers(queries, vector, probes).alias("_y"))
    if probes is None:
        idx = idx.where(F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    shape = idx.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("d")).first()
    n, d = int(shape["n"]), int(shape["d"] or 0)
    if probes is not None:
        found = _nearest_probed(qs, idx, n, k, exclude_self, block_rows, query_rows, probes)
    elif not n or n * d <= broadcast_values:
        found = _nearest_broadcast(qs, idx, d, k, exclude_self, query_rows)
    else:
        own = int(idx.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]) if exclude_self else 1
        found = MetricIndex(_spread(idx, QUERY_ROWS), n, d, k, block_rows, query_rows, work=work, own=own).search(_spread(qs, QUERY_ROWS), exclude_self)
    return found.withColumnRenamed("_q", query_key)


def _numbers(df: DataFrame, vector: str, probes: int | None) -> Column:
    """The vectors as doubles; floats are widened only where distances are taken."""
    return F.col(vector) if probes is None and dict(df.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """The frame stored and dealt to tasks by its number of rows: they are small, but with much work each."""
    stored = cut(df)
    return stored.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // rows)))


#: Rows of a cell where a whole index of wide vectors goes to every task.
CELL_ROWS = 256


def _collected(idx: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and ids of a small frame, moved as bytes."""

    def pack(batches):
        for b in batches:
            if len(b):
                yield pd.DataFrame({"x": [vectors(b["_x"], width).tobytes()], "i": [b["_i"].to_numpy(dtype=np.int64).tobytes()]})

    rows = idx.mapInPandas(pack, "x binary, i binary").collect()  # at most broadcast_values numbers, checked by the caller
    x = np.concatenate([np.empty(0), *[np.frombuffer(r["x"]) for r in rows]])
    ids = np.concatenate([np.empty(0, np.int64), *[np.frombuffer(r["i"], np.int64) for r in rows]])
    return x.reshape(len(ids), width), ids


def _nearest_broadcast(qs: DataFrame, idx: DataFrame, width: int, k: int, exclude_self: bool, query_rows: int) -> DataFrame:
    x, ids = _collected(idx, width)
    # a row's own entries are found with its neighbours and left out afterwards
    more = int(np.unique(ids, return_counts=True)[1].max(initial=0)) if exclude_self else 0
    x, ids = few_copies(x, ids, k + more)
    narrow = x.shape[1] <= NARROW
    held = qs.sparkSession.sparkContext.broadcast(BoxIndex(x, ids) if narrow else (x, ids))

    def in_boxes(batches):
        for b in _gathered(batches, query_rows):
            keys = b["_q"].to_numpy(dtype=np.int64)
            d, i, _ = held.value.nearest(vectors(b["_y"], width), k + more)
            yield from _results(keys, *(without_own(d, i, keys, k) if exclude_self else (d, i)))

    def in_cells(batches):
        shelf = _shelf(*held.value, k + more)
        for b in batches:
            if len(b):
                keys = b["_q"].to_numpy(dtype=np.int64)
                d, i, _ = shelf.nearest(vectors(b["_y"], width), np.full(len(b), np.inf), k, keys if exclude_self else None, more)
                yield _result(keys, d, i)

    def nothing(batches):
        for b in batches:
            yield _result(b["_q"], np.empty((len(b), 0)), np.empty((len(b), 0), np.int64))

    return _spread(qs, query_rows).mapInPandas(nothing if not len(ids) else in_boxes if narrow else in_cells, NEAR_SCHEMA)


def _shelf(x: np.ndarray, ids: np.ndarray, copies: int) -> Shelf:
    """Rows in cells of neighbours around their means."""
    sets = halves(x, CELL_ROWS)
    centre = np.array([x[rows].mean(axis=0) for rows in sets])
    cell = np.empty(len(x), np.int64)
    for c, rows in enumerate(sets):
        cell[rows] = c
    diff = x - centre[cell]
    return Shelf(x, ids, cell, np.sqrt((diff * diff).sum(axis=1)), centre, copies)


def _nearest_probed(qs: DataFrame, idx: DataFrame, n: int, k: int, exclude_self: bool, block_rows: int, query_rows: int, probes: int) -> DataFrame:
    """Approximate: of at most MAX_CELLS coarse cells a query visits the ``probes`` nearest."""
    spark = qs.sparkSession
    centres = idx.orderBy(hash32(F.col("_i"), 11), "_i").limit(cell_count(n)).select("_x").toPandas()  # at most MAX_CELLS rows
    held = spark.sparkContext.broadcast(np.array(centres["_x"].tolist(), dtype=float))

    def nearest_cells(key: str, value: str, count: int):
        def run(batches):
            centre = held.value
            for b in batches:
                if len(b):
                    i = top_k(np.array(b[value].tolist(), dtype=float), centre, np.arange(len(centre)), None, count)[1]
                    rows = np.repeat(np.arange(len(b)), i.shape[1])
                    yield pd.DataFrame({key: b[key].to_numpy()[rows], value: b[value].to_numpy()[rows], "_cell": i.ravel().astype("int32")})

        return run

    placed = cut(idx.mapInPandas(nearest_cells("_i", "_x", 1), "_i long, _x array<double>, _cell int"))
    visits = cut(qs.mapInPandas(nearest_cells("_q", "_y", probes), "_q long, _y array<double>, _cell int"))

    def parts(df: DataFrame, rows: int, out: str) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(out))

    plan = F.broadcast(cut(parts(placed, block_rows, "_blocks").join(parts(visits, query_rows, "_chunks"), "_cell")))  # at most MAX_CELLS rows

    def slot(key: str, seed: int, count: str) -> Column:
        return F.floor(hash32(F.col(key), seed) * F.col(count) / F.lit(SPACE)).cast("int")

    left = visits.join(plan, "_cell").select("_q", "_y", "_cell", slot("_q", 3, "_chunks").alias("_chunk"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    right = placed.join(plan, "_cell").select("_i", "_x", "_cell", slot("_i", 5, "_blocks").alias("_block"), F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"_q": pd.Series([], dtype="int64"), "distance": pd.Series([], dtype=float), "id": pd.Series([], dtype="int64")})
        keys = a["_q"].to_numpy(dtype=np.int64)
        d, i = top_k(np.array(a["_y"].tolist(), dtype=float), np.array(b["_x"].tolist(), dtype=float), b["_i"].to_numpy(dtype=np.int64), keys if exclude_self else None, k)
        ok = np.isfinite(d)
        return pd.DataFrame({"_q": np.repeat(keys, d.shape[1])[ok.ravel()], "distance": d[ok], "id": i[ok]})

    keys = ["_cell", "_block", "_chunk"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "_q long, distance double, id long")
    best = Window.partitionBy("_q").orderBy("distance", "id")
    top = partial.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    packed = top.groupBy("_q").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("p"))  # at most k per query
    return qs.select("_q").join(packed, "_q", "left").select(
        "_q",
        F.coalesce(F.col("p.distance"), F.array().cast("array<double>")).alias("distances"),
        F.coalesce(F.col("p.id"), F.array().cast("array<long>")).alias("neighbour_ids"),
    )


DISTANCE_FEATURES = ("mean_dist_converters", "min_dist_converter", "max_dist_converter", "std_dist_converters")


def distance_features(
    df: DataFrame, positives: DataFrame, vector: str, key: str, k: int = N_NEIGHBORS, exclude_self: bool = False, **kw
) -> DataFrame:
    """Mean, least, greatest and population standard deviation of the distances to the k nearest positives.

    With fewer than k positives all are 0. ``exclude_self`` leaves a row's own
    entry among the positives out; off by default, so a positive finds itself.
    """
    if positives.count() < k:
        return df.withColumns({c: F.lit(0.0) for c in DISTANCE_FEATURES})
    near = nearest(df, positives, vector, key, key, k, exclude_self, **kw)
    n = F.nullif(F.size("distances"), F.lit(0))  # a row without neighbours has no distances
    mean = F.aggregate("distances", F.lit(0.0), lambda a, x: a + x) / n
    feats = near.select(key, "distances", mean.alias("mean_dist_converters")).select(
        key,
        "mean_dist_converters",
        F.array_min("distances").alias("min_dist_converter"),
        F.array_max("distances").alias("max_dist_converter"),
        F.sqrt(
            F.aggregate(
                F.transform("distances", lambda x: (x - F.col("mean_dist_converters")) * (x - F.col("mean_dist_converters"))), F.lit(0.0), lambda a, x: a + x
            )
            / n
        ).alias("std_dist_converters"),
    )
    return df.join(feats, key, "left")


@dataclass(frozen=True)
class LookalikeModel:
    """Fitted look-alike features; the positives stay a table."""

    clusters: ClusterRateModel | None
    numeric: tuple[str, ...]
    stats: dict
    positives: DataFrame | None
    k: int
    key: str

    @property
    def feature_names(self) -> list[str]:
        names = ["cluster_conversion_rate", "cluster_id"] if self.clusters is not None else []
        return names + (list(DISTANCE_FEATURES) if self.positives is not None else [])

    def transform(self, df: DataFrame, exclude_self: bool = False) -> DataFrame:
        out = self.clusters.transform(df) if self.clusters is not None else df
        if self.positives is None:
            return out
        scaled, _ = standardize(df.select(self.key, *self.numeric), list(self.numeric), self.stats)
        vectors = scaled.select(self.key, F.array(*self.numeric).alias("_vec"))
        feats = distance_features(vectors, self.positives, "_vec", self.key, self.k, exclude_self).drop("_vec")
        return out.join(feats, self.key, "left")


def fit_lookalike(
    train: DataFrame,
    target: str = "target",
    key: str = "row_key",
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    n_clusters: int = N_CLUSTERS,
    n_neighbors: int = N_NEIGHBORS,
    use_clusters: bool = True,
    use_distances: bool = True,
    seed: int = 42,
    **cluster_args,
) -> LookalikeModel:
    """Fit cluster rates and the table of converters on the training rows only."""
    found_cat, found_num = autodetect_roles(train, exclude=(key, target))
    numeric, categorical = numeric if numeric is not None else found_num, categorical if categorical is not None else found_cat
    clusters = None
    if use_clusters:
        clusters = fit_cluster_rates(train, numeric, categorical, target, key, n_clusters, seed=seed, **cluster_args)
    positives, stats = None, {}
    if use_distances and numeric:
        scaled, stats = standardize(train.select(key, target, *numeric), numeric)
        positives = cut(scaled.where(F.col(target) == 1).select(key, F.array(*numeric).alias("_vec")))
    return LookalikeModel(clusters, tuple(numeric), stats, positives, n_neighbors, key)


def add_lookalike_features(train: DataFrame, others: dict[str, DataFrame] | None = None, **fit_args) -> dict[str, DataFrame]:
    """The training frame and any others with the features fitted on training."""
    model = fit_lookalike(train, **fit_args)
    return {name: model.transform(df) for name, df in {"train": train, **(others or {})}.items()}


