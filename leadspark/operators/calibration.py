"""Probability calibration: isotonic, sigmoid and beta.

Calibrators fit on distinct scores with counts, which gives the same curve as
the rows and keeps the fit small where scores repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.functions.features import clip01, is_finite
from leadspark.operators.isotonic import interpolate, pools
from leadspark.operators.ranking import ROWS_PER_BUCKET

# Methods, the least number of scores for beta calibration, and its clamp.
METHODS = ("isotonic", "sigmoid", "beta")
MIN_BETA_ROWS = 10
CLAMP = 1e-9


@dataclass
class IsotonicCalibrator:
    """Pools of an isotonic fit; they stay a table."""

    pools: DataFrame

    def apply(self, df: DataFrame, score: str, out: str) -> DataFrame:
        return interpolate(df, score, self.pools, out).withColumn(out, clip01(F.col(out)))


@dataclass
class LogisticCalibrator:
    """Sigmoid of a linear form in transformed scores; a plain column expression."""

    kind: str
    coefficients: tuple[float, ...]
    intercept: float

    def apply(self, df: DataFrame, score: str, out: str) -> DataFrame:
        z: Column = F.lit(self.intercept)
        for x, w in zip(_inputs(self.kind, F.col(score)), self.coefficients):
            z = z + x * F.lit(w)
        return df.withColumn(out, clip01(F.lit(1.0) / (F.lit(1.0) + F.exp(-z))))


def _inputs(kind: str, p: Column) -> list[Column]:
    if kind == "sigmoid":
        return [p]
    q = F.least(F.greatest(p, F.lit(CLAMP)), F.lit(1 - CLAMP))
    return [F.log(q), -F.log(F.lit(1.0) - q)]


def _counts(df: DataFrame, score: str, target: str) -> DataFrame:
    return (
        df.where(is_finite(F.col(score)))
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(target).cast("double")).alias("pos"))
    )


def fit_isotonic(df: DataFrame, score: str = "p", target: str = "target", rows_per_bucket: int = ROWS_PER_BUCKET) -> IsotonicCalibrator:
    return IsotonicCalibrator(pools(_counts(df, score, target), rows_per_bucket))


def _logistic(data: DataFrame, kind: str) -> LogisticCalibrator:
    inputs = _inputs(kind, F.col("s"))
    frame = data.select(array_to_vector(F.array(*inputs)).alias("features"), "label", "weight").where(F.col("weight") > 0)
    lr = LogisticRegression(weightCol="weight", maxIter=200, tol=1e-9)
    if kind == "beta":
        lr = lr.setLowerBoundsOnCoefficients(Matrices.dense(1, len(inputs), [0.0] * len(inputs)))
    m = lr.fit(frame)
    return LogisticCalibrator(kind, tuple(float(c) for c in m.coefficients.toArray()), float(m.intercept))


def fit_sigmoid(df: DataFrame, score: str = "p", target: str = "target") -> LogisticCalibrator:
    """Platt scaling with smoothed targets."""
    counts = _counts(df, score, target)
    t = counts.agg(F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q")).first()
    hi, lo = ((t["p"] or 0) + 1) / ((t["p"] or 0) + 2), 1 / ((t["q"] or 0) + 2)
    neg = F.col("n") - F.col("pos")
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("pos") * hi + neg * lo).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("pos") * (1 - hi) + neg * (1 - lo)).alias("weight")),
    )
    return _logistic(counts.select("s", F.explode(both).alias("x")).select("s", "x.*"), "sigmoid")


def fit_beta(df: DataFrame, score: str = "p", target: str = "target") -> LogisticCalibrator:
    """Beta calibration with parameters a, b, m (Kull et al. 2017), a and b not negative."""
    counts = _counts(df, score, target)
    n = counts.agg(F.sum("n")).first()[0] or 0
    if n < MIN_BETA_ROWS:
        raise ValueError(f"{n:.0f} scores are too few for beta calibration")
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("pos").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("pos")).alias("weight")),
    )
    return _logistic(counts.select("s", F.explode(both).alias("x")).select("s", "x.*"), "beta")


def fit_calibrator(df: DataFrame, method: str = "isotonic", score: str = "p", target: str = "target"):
    """Calibrator by name; an unknown name means isotonic."""
    if method == "sigmoid":
        return fit_sigmoid(df, score, target)
    if method == "beta":
        return fit_beta(df, score, target)
    return fit_isotonic(df, score, target)
