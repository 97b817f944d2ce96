"""Clusters with conversion rates and distances to converters."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.operators import lookalike as K
from leadspark.operators.splits import split_by_dates
from leadspark.plans.frames import PANEL_SQL, features, panel
from leadspark.registry import query
from leadspark.session import cut
from leadspark.sources.tables import read_table

POSITIVE_LABEL = 3

KNN_SQL = f"""WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
pairs AS (SELECT a.vec_id, b.vec_id AS neighbour_id, list_distance(a.e, b.e) AS d FROM q a JOIN q b ON b.label = {POSITIVE_LABEL}),
near AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour_id) AS rank FROM pairs),
top AS (SELECT * FROM near WHERE rank <= 20)"""


def _embeddings(spark, sf):
    return read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def _near(spark, sf, **kw):
    e = _embeddings(spark, sf)
    return K.nearest(e, e.where(F.col("label") == POSITIVE_LABEL), "embedding", "vec_id", "vec_id", K.N_NEIGHBORS, **kw)


@query("lk_knn", KNN_SQL + """ SELECT vec_id, round(avg(d), 6) AS mean_dist_converters, round(min(d), 6) AS min_dist_converter,
  round(max(d), 6) AS max_dist_converter, round(stddev_pop(d), 6) AS std_dist_converters FROM top GROUP BY vec_id""")
def lk_knn(spark, sf):
    e = _embeddings(spark, sf)
    positives = e.where(F.col("label") == POSITIVE_LABEL).select("vec_id", "embedding")
    out = K.distance_features(e.select("vec_id", "embedding"), positives, "embedding", "vec_id")
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in K.DISTANCE_FEATURES])


@query("join_knn", KNN_SQL + " SELECT vec_id, neighbour_id, round(d, 6) AS distance FROM top")
def join_knn(spark, sf):
    pairs = _near(spark, sf).select("vec_id", F.explode(F.arrays_zip("neighbour_ids", "distances")).alias("p"))
    return pairs.select("vec_id", F.col("p.neighbour_ids").alias("neighbour_id"), F.round("p.distances", 6).alias("distance"))


@query("topk_neighbors", KNN_SQL + " SELECT vec_id, rank, round(d, 6) AS distance FROM top")
def topk_neighbors(spark, sf):
    """The same search through bounded cells and blocks."""
    found = _near(spark, sf, broadcast_values=0, block_rows=16, query_rows=128)
    rows = found.select("vec_id", F.posexplode("distances").alias("pos", "d"))
    return rows.select("vec_id", (F.col("pos") + 1).cast("long").alias("rank"), F.round("d", 6).alias("distance"))


@query(
    "lk_ivf_params",
    f"""SELECT count(*) AS n_positives, least(100, greatest(10, CAST(floor(sqrt(count(*))) AS BIGINT))) AS cells,
least(10, least(100, greatest(10, CAST(floor(sqrt(count(*))) AS BIGINT)))) AS probes FROM embeddings WHERE label = {POSITIVE_LABEL}""",
)
def lk_ivf_params(spark, sf):
    n = F.col("n_positives")
    cells = F.least(F.lit(K.MAX_CELLS), F.greatest(F.lit(K.MIN_CELLS), F.floor(F.sqrt(n)))).cast("long")
    counted = _embeddings(spark, sf).where(F.col("label") == POSITIVE_LABEL).agg(F.count(F.lit(1)).alias("n_positives"))
    return counted.withColumn("cells", cells).withColumn("probes", F.least(F.lit(K.MAX_PROBES).cast("long"), "cells"))


# Prototypes of the SQL checks: mean size and most frequent canton per legal form, rounded so both engines agree.
PROTO_SQL = """, b AS (SELECT row_key, target, legal_form, coalesce(canton, 'missing') AS canton, coalesce(headcount, 0) / 100 AS x, coalesce(revenue, 0) / 1000 AS y, snapshot_date FROM panel),
ctr AS (SELECT legal_form, round(avg(x), 3) AS cx, round(avg(y), 3) AS cy FROM b GROUP BY 1),
md AS (SELECT legal_form, canton AS cm FROM (SELECT legal_form, canton, row_number() OVER (PARTITION BY legal_form ORDER BY count(*) DESC, canton DESC) AS r FROM b GROUP BY 1, 2) WHERE r = 1),
proto AS (SELECT row_number() OVER (ORDER BY ctr.legal_form) - 1 AS cluster_id, cx, cy, cm FROM ctr JOIN md ON ctr.legal_form = md.legal_form),
asg AS (SELECT row_key, target, snapshot_date, cluster_id FROM (
  SELECT b.row_key, b.target, b.snapshot_date, p.cluster_id,
    row_number() OVER (PARTITION BY b.row_key ORDER BY (b.x - cx) * (b.x - cx) + (b.y - cy) * (b.y - cy) + CASE WHEN b.canton = cm THEN 0 ELSE 0.5::DOUBLE END, p.cluster_id) AS r
  FROM b, proto p) WHERE r = 1)"""


def _base(spark, sf):
    return panel(spark, sf).select(
        "row_key", "target", "legal_form", "snapshot_date", F.coalesce("canton", F.lit("missing")).alias("canton"),
        (F.coalesce("headcount", F.lit(0.0)) / 100).alias("x"), (F.coalesce("revenue", F.lit(0.0)) / 1000).alias("y"),
    )


def _prototypes(df):
    centres = df.groupBy("legal_form").agg(F.round(F.avg("x"), 3).alias("cx"), F.round(F.avg("y"), 3).alias("cy"))
    counts = df.groupBy("legal_form", "canton").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("legal_form").agg(F.max_by("canton", F.struct("n", "canton")).alias("cm"))
    rows = centres.join(modes, "legal_form").orderBy("legal_form").collect()  # one row per legal form
    return K.Prototypes(("x", "y"), ("canton",), tuple((r["cx"], r["cy"]) for r in rows), tuple((r["cm"],) for r in rows), 0.5)


@query("lk_assign", "WITH " + PANEL_SQL + PROTO_SQL + " SELECT row_key, CAST(cluster_id AS INTEGER) AS cluster_id FROM asg")
def lk_assign(spark, sf):
    df = _base(spark, sf)
    return K.assign_clusters(df, _prototypes(df)).select("row_key", "cluster_id")


@query(
    "lk_cluster_rate",
    "WITH " + PANEL_SQL + PROTO_SQL + """ SELECT CAST(cluster_id AS INTEGER) AS cluster_id, round((sum(target) + (SELECT avg(target) FROM asg) * 15) / (count(*) + 15), 6) AS rate FROM asg GROUP BY 1""",
)
def lk_cluster_rate(spark, sf):
    df = _base(spark, sf)
    return K.cluster_rates(K.assign_clusters(df, _prototypes(df))).withColumn("rate", F.round("rate", 6))


@query(
    "join_rate_lookup",
    "WITH " + PANEL_SQL + PROTO_SQL + """, d AS (SELECT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date DESC) AS r FROM (SELECT DISTINCT snapshot_date FROM panel)),
tr AS (SELECT a.* FROM asg a JOIN d ON a.snapshot_date = d.snapshot_date WHERE d.r > 2),
rates AS (SELECT cluster_id, (sum(target) + (SELECT avg(target) FROM tr) * 15) / (count(*) + 15) AS rate FROM tr WHERE cluster_id <> 0 GROUP BY 1)
SELECT a.row_key, round(coalesce(rate, (SELECT avg(target) FROM tr)), 6) AS cluster_conversion_rate FROM asg a LEFT JOIN rates ON a.cluster_id = rates.cluster_id""",
)
def join_rate_lookup(spark, sf):
    """Rates of the training dates looked up for all rows; a cluster without a rate gets the overall one."""
    from leadspark.operators.lookup import lookup_join

    df = _base(spark, sf)
    marked = K.assign_clusters(df, _prototypes(df))
    train, _, _ = split_by_dates(marked)
    rates = K.cluster_rates(train).where(F.col("cluster_id") != 0)
    overall = train.agg(F.avg("target")).first()[0]
    joined = lookup_join(marked, rates, "cluster_id")
    return joined.select("row_key", F.round(F.coalesce("rate", F.lit(overall)), 6).alias("cluster_conversion_rate"))


NUMBERS = ["headcount", "revenue", "company_age_years", "risk_class"]
TEXTS = ["canton", "legal_form", "size_class"]
FIT = dict(k=8, n_init=1, max_iter=6)


@query("lk_kproto")
def lk_kproto(spark, sf):
    """Fitted mixed-type clusters: size and conversion rate of each."""
    from leadspark.operators.encoders import standardize

    df, _ = standardize(features(spark, sf).select("row_key", "target", *NUMBERS, *TEXTS), NUMBERS)
    p = K.fit_prototypes(df, NUMBERS, TEXTS, "row_key", **FIT)
    return K.assign_clusters(df, p).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate"), *[F.avg(c).alias(c) for c in NUMBERS]
    )


@query(
    "lk_cluster_features",
    "WITH " + PANEL_SQL + PROTO_SQL + """, d AS (SELECT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date DESC) AS r FROM (SELECT DISTINCT snapshot_date FROM panel)),
tr AS (SELECT a.* FROM asg a JOIN d ON a.snapshot_date = d.snapshot_date WHERE d.r > 2),
rates AS (SELECT cluster_id, (sum(target) + (SELECT avg(target) FROM tr) * 15) / (count(*) + 15) AS rate FROM tr GROUP BY 1)
SELECT a.row_key, CAST(a.cluster_id AS INTEGER) AS cluster_id, round(coalesce(rate, (SELECT avg(target) FROM tr)), 6) AS cluster_conversion_rate
FROM asg a LEFT JOIN rates ON a.cluster_id = rates.cluster_id""",
)
def lk_cluster_features(spark, sf):
    """A cluster model with given prototypes and rates of the training dates, applied to all rows."""
    df = _base(spark, sf)
    p = _prototypes(df)
    train, _, _ = split_by_dates(K.assign_clusters(df, p))
    rates = {r["cluster_id"]: r["rate"] for r in K.cluster_rates(train).collect()}  # one row per cluster
    overall = train.agg(F.avg("target")).first()[0]
    model = K.ClusterRateModel(p, {"x": (0.0, 1.0), "y": (0.0, 1.0)}, rates, overall)
    return model.transform(df).select("row_key", "cluster_id", F.round("cluster_conversion_rate", 6).alias("cluster_conversion_rate"))


@query("lk_combined")
def lk_combined(spark, sf):
    """Training, validation and test rows with every look-alike feature fitted on training."""
    rows = cut(features(spark, sf).select("row_key", "snapshot_date", "target", *NUMBERS, *TEXTS), spread=True)  # read by every fit and frame below
    train, val, test = split_by_dates(rows)
    frames = K.add_lookalike_features(train, {"val": val, "test": test}, numeric=NUMBERS, categorical=TEXTS)
    cols = ["row_key", "cluster_id", "cluster_conversion_rate", *[c for c in K.DISTANCE_FEATURES if c in frames["train"].columns]]
    out = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("split"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


@query("smp_smote")
def smp_smote(spark, sf):
    from leadspark.operators.encoders import standardize
    from leadspark.operators.sampling import smote

    df, _ = standardize(features(spark, sf).select("row_key", "target", *NUMBERS), NUMBERS)
    vectors = df.select("row_key", "target", F.array(*NUMBERS).alias("features"))
    return smote(vectors, ratio=0.1)


