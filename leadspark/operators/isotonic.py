"""Isotonic regression by pooling adjacent violators in ordered buckets.

Scores lie in buckets along their order; each bucket pools its adjacent
violators on its own. Then the pools are dealt to buckets with other edges and
pooled again, until no two neighbours are out of order anywhere, which is the
solution whatever the order of pooling. Pools stay a table; the driver sees the
edges of buckets and a count of violations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadspark.operators.lookup import lookup_join
from leadspark.operators.ranking import ROWS_PER_BUCKET, with_order_bucket
from leadspark.session import cut

POOL = "lo double, hi double, n double, pos double"


def pool_violators(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pools of neighbours in order of ``lo`` whose means would fall."""
    out: list[list[float]] = []
    for a, b, w, p in zip(lo, hi, n, pos):
        out.append([a, b, w, p])
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            _, b2, w2, p2 = out.pop()
            out[-1][1] = b2
            out[-1][2] += w2
            out[-1][3] += p2
    return tuple(np.array(c, float) for c in zip(*out)) if out else (np.empty(0),) * 4


def _pool_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("lo")
    return pd.DataFrame(dict(zip(("lo", "hi", "n", "pos"), pool_violators(*(pdf[c].to_numpy(float) for c in ("lo", "hi", "n", "pos"))))))


def pools(counts: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """lo, hi, n, pos of each pool of the isotonic fit of ``counts`` (s, n, pos), one row for each score."""
    blocks = cut(counts.select(F.col("s").alias("lo"), F.col("s").alias("hi"), F.col("n").cast("double").alias("n"), F.col("pos").cast("double").alias("pos")))
    shift = 0
    while True:
        placed, used = with_order_bucket(blocks, F.col("lo"), F.col("lo"), rows_per_bucket)
        # buckets are taken by twos, and by other twos in the next round, so no two neighbours stay apart
        number = placed.select("_bucket").distinct().select("_bucket", F.row_number().over(Window.orderBy("_bucket")).alias("b"))  # one row a bucket
        twos = placed.join(F.broadcast(number), "_bucket").withColumn("b", F.floor((F.col("b") + shift) / 2).cast("long"))
        pooled = cut(twos.groupBy("b").applyInPandas(lambda key, pdf: _pool_bucket(pdf).assign(b=key[0]), POOL + ", b long"))
        if used == 1 or not _violations(pooled):
            return pooled.drop("b")
        blocks, shift = pooled.drop("b"), 1 - shift


def _violations(pooled: DataFrame) -> int:
    """Neighbouring buckets whose edge pools are out of order; buckets in order hold ordered pools."""
    ends = pooled.groupBy("b").agg(F.min_by(F.struct("n", "pos"), "lo").alias("first"), F.max_by(F.struct("n", "pos"), "lo").alias("last"))
    before = F.lag("last").over(Window.orderBy("b"))  # one row a bucket
    return ends.withColumn("before", before).where(F.col("before.pos") * F.col("first.n") >= F.col("first.pos") * F.col("before.n")).count()


def interpolate(df: DataFrame, score: str, fitted: DataFrame, out: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with the fitted value of each score: a pool's mean inside it, on the line between two pools, the outermost beyond them.

    Rows without a finite score get null.
    """
    value = F.col("pos") / F.col("n")
    corners = fitted.select(F.explode(F.array(F.struct(F.col("lo").alias("x"), value.alias("v")), F.struct(F.col("hi").alias("x"), value.alias("v")))).alias("c")).select("c.x", "c.v")
    x = F.col(score).cast("double") + F.lit(0.0)
    asked = df.select(x.alias("x")).groupBy("x").agg(F.lit(None).cast("double").alias("v"))
    rows = cut(asked.unionByName(corners))
    bucketed, buckets = with_order_bucket(rows, F.col("x"), F.coalesce("v", F.lit(-1.0)), rows_per_bucket)
    corner = F.when(F.col("v").isNotNull(), F.struct("x", "v"))
    # both windows run from their start, one along the scores and one against them: a frame that is open at its end is read anew for every row
    along, against = (Window.partitionBy("_bucket").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc("x"), F.desc("x")))
    left = F.last(corner, ignorenulls=True).over(along)
    right = F.last(corner, ignorenulls=True).over(against)
    local = bucketed.withColumns({"left": left, "right": right})
    if buckets > 1:
        ends = bucketed.groupBy("_bucket").agg(F.min_by(corner, F.when(F.col("v").isNotNull(), F.col("x"))).alias("first"), F.max_by(corner, F.when(F.col("v").isNotNull(), F.col("x"))).alias("last"))
        up, down = (Window.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_bucket"), F.desc("_bucket")))  # one row a bucket
        carried = ends.select(
            "_bucket",
            F.last("last", ignorenulls=True).over(up).alias("before"),
            F.last("first", ignorenulls=True).over(down).alias("after"),
        )
        local = local.join(F.broadcast(carried), "_bucket").withColumns({"left": F.coalesce("left", "before"), "right": F.coalesce("right", "after")})
    step = F.col("right.x") - F.col("left.x")
    line = F.when(step > 0, F.col("left.v") + (F.col("right.v") - F.col("left.v")) * (F.col("x") - F.col("left.x")) / step).otherwise(F.col("left.v"))
    found = local.where(F.col("v").isNull()).select("x", F.coalesce(line, F.col("left.v"), F.col("right.v")).alias(out))
    return lookup_join(df.withColumn("_x", x), found.withColumnRenamed("x", "_x"), "_x").drop("_x")
