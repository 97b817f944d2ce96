"""Ranking, threshold and calibration metrics of a (key, target, score) frame.

Curves are built on distinct scores: rows collapse map-side to one count per
score, so ties cost nothing, and running sums cross tasks without a global sort
task. Each metric is a one-row frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadspark.functions.features import is_finite
from leadspark.operators.ranking import ROWS_PER_BUCKET, exact_quantiles, quantile_group, running_sums, top_k, with_rank
from leadspark.session import cut

EPS = 1e-12


def positives_share(df: DataFrame, target: str = "target") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0)).alias("positives"),
        F.avg(F.col(target).cast("double")).alias("rate"),
    )


def at_k(df: DataFrame, k: int, target: str = "target", score: str = "score", key: str = "row_key") -> DataFrame:
    """precision, recall and lift among the k best rows; 0 where undefined."""
    df = df.where(is_finite(F.col(score)))
    best = top_k(df.select(key, target, score), score, key, k).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0)).alias("_tp")
    )
    totals = df.agg(F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0)).alias("_p"), F.count(F.lit(1)).alias("_all")).first()
    p, n = F.lit(totals["_p"]).cast("double"), F.lit(totals["_all"]).cast("double")
    precision = F.when(F.col("_n") > 0, F.col("_tp") / F.col("_n")).otherwise(F.lit(0.0))
    return best.select(
        precision.alias("precision_at_k"),
        F.when(p > 0, F.col("_tp") / F.nullif(p, F.lit(0.0))).otherwise(F.lit(0.0)).alias("recall_at_k"),
        F.when(p > 0, precision / F.nullif(p / n, F.lit(0.0))).otherwise(F.lit(0.0)).alias("lift_at_k"),
    )


def score_counts(df: DataFrame, target: str = "target", score: str = "score") -> DataFrame:
    """(score, n, pos): one row per distinct score. Rows without a finite score are left out, here and in all curves."""
    return df.where(is_finite(F.col(score).cast("double"))).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("pos")
    )


def curve(df: DataFrame, target: str = "target", score: str = "score", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per distinct score: counts, counts at or above it, and the totals.

    The counts are stored first: the source is read once, whatever follows.
    """
    return _running(cut(score_counts(df, target, score)), rows_per_bucket)


def _running(counts: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Stored (score, n, pos) counts with counts at or above each score and the totals."""
    totals = counts.agg(F.sum("n").alias("n"), F.sum("pos").alias("p")).first()
    cum = running_sums(
        counts, -F.col("score"), F.lit(0), {"n_above": F.col("n"), "tp": F.col("pos")}, rows_per_bucket
    )
    return cum.withColumns(
        {
            "fp": F.col("n_above") - F.col("tp"),
            "total_pos": F.lit(totals["p"] or 0).cast("long"),
            "total_neg": F.lit((totals["n"] or 0) - (totals["p"] or 0)).cast("long"),
        }
    )


def _recall() -> Column:
    return F.coalesce(F.col("tp") / F.nullif(F.col("total_pos").cast("double"), F.lit(0.0)), F.lit(1.0))


def pr_curve(df: DataFrame, **kw) -> DataFrame:
    """precision and recall at every distinct score, and the end point (1, 0) without a threshold."""
    points = curve(df, **kw).select(
        F.col("score").alias("threshold"), (F.col("tp") / F.col("n_above")).alias("precision"), _recall().alias("recall")
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def _precision_step() -> Column:
    return (F.col("pos") / F.nullif(F.col("total_pos").cast("double"), F.lit(0.0))) * (F.col("tp") / F.col("n_above"))


def average_precision(df: DataFrame, **kw) -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    return curve(df, **kw).agg(F.coalesce(F.sum(_precision_step()), F.lit(0.0)).alias("average_precision"))


def roc_curve(df: DataFrame, **kw) -> DataFrame:
    fpr = F.col("fp") / F.nullif(F.col("total_neg").cast("double"), F.lit(0.0))
    tpr = F.col("tp") / F.nullif(F.col("total_pos").cast("double"), F.lit(0.0))
    points = curve(df, **kw).select(F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def auc(df: DataFrame, **kw) -> DataFrame:
    """Area under ROC as a rank sum with ties counted half; null if a class is absent."""
    below = F.col("total_neg") - F.col("fp")
    same = F.col("n") - F.col("pos")
    pairs = (F.col("total_pos") * F.col("total_neg")).cast("double")
    win = F.col("pos") * (below + same / F.lit(2.0))
    return curve(df, **kw).agg((F.sum(win) / F.nullif(F.max(pairs), F.lit(0.0))).alias("auc"))


def youden_threshold(df: DataFrame, **kw) -> DataFrame:
    """Score that maximises TPR - FPR; the highest such score on ties.

    Where ROC is undefined the best F1 decides, and 0.5 where that is undefined too.
    """
    c = curve(df, **kw)
    tpr = F.col("tp") / F.nullif(F.col("total_pos").cast("double"), F.lit(0.0))
    fpr = F.col("fp") / F.nullif(F.col("total_neg").cast("double"), F.lit(0.0))
    p = F.col("tp") / F.col("n_above")
    f1 = 2 * p * _recall() / (p + _recall() + EPS)
    c = c.select("score", (tpr - fpr).alias("j"), f1.alias("f1"))
    return c.agg(
        F.max_by("score", F.when(F.col("j").isNotNull(), F.struct("j", "score"))).alias("_j"),
        F.max("j").alias("youden_j"),
        F.max_by("score", F.struct("f1", -F.col("score"))).alias("_f"),
    ).select(F.coalesce("_j", "_f", F.lit(0.5)).alias("threshold"), "youden_j")


def best_fbeta(df: DataFrame, beta: float = 2.0, **kw) -> DataFrame:
    """Threshold with the highest F-beta; the lowest such threshold on ties, 0.5 without rows."""
    threshold, f = _best_fbeta(beta)
    return curve(df, **kw).agg(threshold.alias("threshold"), f.alias("f_beta"))


def _best_fbeta(beta: float) -> tuple[Column, Column]:
    """Aggregates over a curve: the threshold with the highest F-beta, and that value."""
    b2 = beta * beta
    p, r = F.col("tp") / F.col("n_above"), _recall()
    f = (1 + b2) * (p * r) / (b2 * p + r + EPS)
    return F.coalesce(F.max_by("score", F.struct(f.alias("f"), (-F.col("score")).alias("s"))), F.lit(0.5)), F.max(f)


def recall_threshold(df: DataFrame, target_recall: float = 0.95, **kw) -> DataFrame:
    """Highest threshold that still reaches the recall, else the lowest threshold."""
    c = curve(df, **kw).select("score", _recall().alias("recall"), (F.col("tp") / F.col("n_above")).alias("precision"))
    ok = F.col("recall") >= target_recall
    point = F.struct("score", "recall", "precision")
    picked = c.agg(F.coalesce(F.max(F.when(ok, point)), F.min(point)).alias("x"))
    return picked.select(F.col("x.score").alias("threshold"), F.col("x.recall").alias("recall"), F.col("x.precision").alias("precision"))


def top_k_threshold(df: DataFrame, k: int, score: str = "score") -> DataFrame:
    """k-th largest finite score; k is cut to the row count; 1.0 without rows or with k <= 0."""
    best = df.where(is_finite(F.col(score))).select(F.col(score).cast("double").alias("s")).orderBy(F.col("s").desc()).limit(max(int(k), 0))
    return best.agg(F.coalesce(F.min("s"), F.lit(1.0)).alias("threshold"))


def _threshold_counts(t: Column, target: str, score: str) -> list[Column]:
    hit = F.col(score) >= t
    y = F.col(target) == 1

    def count(cond: Column) -> Column:
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0))

    return [
        count(y & hit).alias("tp"),
        count(~y & hit).alias("fp"),
        count(y & ~hit).alias("fn"),
        count(~y & ~hit).alias("tn"),
        F.count(F.lit(1)).alias("support"),
    ]


def at_threshold(df: DataFrame, threshold: float | Column, beta: float = 2.0, target: str = "target", score: str = "score") -> DataFrame:
    """Precision, recall and F-beta of ``score >= threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    c = df.agg(*_threshold_counts(t, target, score))
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    recall = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    b2 = beta * beta
    f = (1 + b2) * (precision * recall) / F.greatest(b2 * precision + recall, F.lit(EPS))
    return c.select(
        t.alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        f.alias("f_beta"),
        "support",
        (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("tp") + F.col("fp")).alias("predicted_positives"),
    )


def confusion(df: DataFrame, threshold: float, target: str = "target", score: str = "score") -> DataFrame:
    return df.agg(*_threshold_counts(F.lit(float(threshold)), target, score)).select("tn", "fp", "fn", "tp")


def brier(df: DataFrame, target: str = "target", score: str = "score") -> DataFrame:
    """Mean squared error of the probability: overall, positives only, negatives only."""
    e = (F.col(score) - F.col(target)) * (F.col(score) - F.col(target))
    return df.agg(
        F.avg(e).alias("brier"),
        F.avg(F.when(F.col(target) == 1, e)).alias("brier_pos"),
        F.avg(F.when(F.col(target) == 0, e)).alias("brier_neg"),
    )


def ece_at_k(df: DataFrame, k: int, bins: int = 10, target: str = "target", score: str = "score", key: str = "row_key") -> DataFrame:
    """Expected calibration error among the k best rows, in equal-width bins on [0, 1]."""
    best = top_k(df.select(key, target, score), score, key, k)
    inside = (F.col(score) >= 0) & (F.col(score) <= 1)
    bin_no = F.when(inside, F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)))
    groups = best.groupBy(bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("p"), F.avg(F.col(target).cast("double")).alias("y")
    )
    gap = F.sum(F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(F.col("p") - F.col("y"))))
    total = F.sum("n")
    return groups.agg(F.when(total > 0, F.coalesce(gap, F.lit(0.0)) / total).alias("ece"))


def calibration_curve(df: DataFrame, bins: int = 10, target: str = "target", score: str = "score") -> DataFrame:
    """Mean score and positive share per quantile bin; empty bins are left out."""
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(df, [score], inner)[score]
    bin_no = F.lit(0)
    for e in edges:
        if e is not None:
            bin_no = bin_no + (F.col(score) > F.lit(e)).cast("int")
    return df.groupBy(bin_no.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(target).cast("double")).alias("positive_share")
    )


def with_deciles(df: DataFrame, score: str, key: str, bins: int = 10, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Finite scores with their rank from the top and quantile group."""
    ok = df.where(is_finite(F.col(score)))
    n = ok.count()
    return with_rank(ok, -F.col(score), F.col(key), rows_per_bucket=rows_per_bucket, n=n).withColumn("decile", quantile_group(F.col("rank"), n, bins))


def gains_table(df: DataFrame, target: str = "target", score: str = "score", key: str = "row_key", bins: int = 10, **kw) -> DataFrame:
    """Per decile from the top: rows, positives, rate and lift over the base rate."""
    per = with_deciles(cut(df.select(key, target, score)), score, key, bins, **kw).groupBy("decile").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("positives")
    )
    everything = Window.partitionBy()  # at most ``bins`` rows
    base = F.sum("positives").over(everything) / F.sum("n").over(everything)
    rate = F.col("positives") / F.greatest(F.col("n"), F.lit(1))
    return per.select("decile", "n", "positives", rate.alias("rate"), (rate / F.greatest(base, F.lit(1e-9))).alias("lift"))


def cumulative_gains(df: DataFrame, target: str = "target", score: str = "score", key: str = "row_key", bins: int = 10, **kw) -> DataFrame:
    """Share of population and of positives reached by each decile."""
    per = with_deciles(cut(df.select(key, target, score)), score, key, bins, **kw).groupBy("decile").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("positives")
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most ``bins`` rows
    everything = Window.partitionBy()
    total_n, total_p = F.sum("n").over(everything), F.sum("positives").over(everything)
    return per.select(
        "decile",
        "n",
        "positives",
        F.sum("positives").over(upto).alias("cum_positives"),
        (F.sum("n").over(upto) / total_n).alias("cum_pct_of_population"),
        (F.sum("positives").over(upto) / F.greatest(total_p, F.lit(1))).alias("cum_pct_of_positives"),
        ((F.col("positives") / F.col("n")) / F.nullif(total_p / total_n, F.lit(0.0))).alias("lift"),
    )


# ---- the report ---------------------------------------------------------------------------------


def counts_between(counts: DataFrame, thresholds: list[float], group: str, n: str = "n", pos: str = "pos", score: str = "score") -> DataFrame:
    """(group, level, n, pos): rows that reach exactly ``level`` of the ascending thresholds, from one pass.

    The range join of scores with thresholds is a band number per row of counts, so
    rows meet their band and not every threshold; at most one row a group and band
    is left. Rows without a finite score reach none.
    """
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    level = F.when(is_finite(F.col(score)), F.size(F.filter(steps, lambda t: F.col(score) >= t))).otherwise(F.lit(0))
    return counts.groupBy(group, level.alias("level")).agg(F.sum(n).alias("n"), F.sum(pos).alias("pos"))


def _at(reached: tuple[int, int], everything: tuple[int, int], threshold: float, beta: float) -> dict:
    """Precision, recall and F-beta from (rows, positives) at or above a threshold and in total."""
    (hit, tp), (n, p) = reached, everything
    precision, recall = tp / max(hit, 1), tp / max(p, 1)
    b2 = beta * beta
    return {
        "threshold": float(threshold), "precision": precision, "recall": recall,
        "f_beta": (1 + b2) * (precision * recall) / max(b2 * precision + recall, EPS),
        "support": n, "positives": p, "predicted_positives": hit,
    }


def threshold_metrics(counts: DataFrame, thresholds: dict[str, float], beta: float, group: str = "split") -> dict[str, dict[str, dict]]:
    """``at_threshold`` of every group at every named threshold, from stored (group, score, n, pos) counts."""
    steps = sorted(set(thresholds.values()))
    bands: dict[str, list] = {}
    for r in counts_between(counts, steps, group).collect():  # at most groups x (thresholds + 1) rows
        bands.setdefault(r[group], []).append((r["level"], r["n"], r["pos"]))

    def reached(rows, level):
        return sum(n for at, n, _ in rows if at >= level), sum(p for at, _, p in rows if at >= level)

    return {
        g: {name: _at(reached(rows, steps.index(t) + 1), reached(rows, 0), t, beta) for name, t in thresholds.items()}
        for g, rows in bands.items()
    }


def report_counts(splits: dict[str, DataFrame], target: str = "target", score: str = "score") -> DataFrame:
    """(split, score, n, pos) of all splits, stored; rows without a score keep a row of their own."""
    parts = [df.select(F.lit(name).alias("split"), F.col(score).cast("double").alias("score"), F.col(target).cast("long").alias("y")) for name, df in splits.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return cut(rows.groupBy("split", "score").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")))


def _kth_score(cum: DataFrame, k: int) -> tuple[float, int] | None:
    """The score at which the k best rows end, and how many of its rows belong to them; None without rows or with k <= 0."""
    row = F.struct("n_above", "score", "n")
    past, last = cum.agg(F.min(F.when(F.col("n_above") >= k, row)), F.max(row)).first()
    if k <= 0 or last is None:
        return None
    end = past or last
    return end["score"], min(k, end["n_above"]) - (end["n_above"] - end["n"])


def _block(cum: DataFrame, end: tuple[float, int] | None, tied: int, at: dict[str, dict], bins: int) -> tuple:
    """All report metrics of one split from its running counts; ``tied`` are the positives taken from the last score."""
    s, hits, misses = F.col("score"), F.col("pos"), F.col("n") - F.col("pos")
    wrong, late = F.sum(hits * (s - 1) * (s - 1)), F.sum(misses * s * s)
    ap = F.coalesce(F.sum(_precision_step()), F.lit(0.0))
    all_n, all_p = F.sum("n"), F.sum("pos")
    none = F.lit(0)
    whole = cum.agg(ap, (wrong + late) / F.nullif(all_n, none), wrong / F.nullif(all_p, none), late / F.nullif(all_n - all_p, none)).first()
    precision, ece = 0.0, None
    if end is not None:
        last = s == F.lit(end[0])
        taken, positives = F.when(last, F.lit(end[1])).otherwise(F.col("n")), F.when(last, F.lit(tied)).otherwise(hits)
        bin_no = F.when((s >= 0) & (s <= 1), F.least(F.floor(s * bins), F.lit(bins - 1)))
        groups = cum.where(s >= F.lit(end[0])).groupBy(bin_no.alias("bin")).agg(F.sum(taken).alias("n"), F.sum(taken * s).alias("p"), F.sum(positives).alias("y")).collect()
        total = sum(g["n"] for g in groups)
        precision = sum(g["y"] for g in groups) / total
        ece = sum(abs(g["p"] - g["y"]) for g in groups if g["bin"] is not None) / total
    return whole[0], precision, tuple(at["fbeta"].values()), tuple(at["topk"].values()), *whole[1:], ece


_AT = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("threshold", "precision", "recall", "f_beta")]
    + [T.StructField(c, T.LongType()) for c in ("support", "positives", "predicted_positives")]
)
_BLOCK = T.StructType(
    [T.StructField("ap", T.DoubleType()), T.StructField("precision_at_k", T.DoubleType()), T.StructField("fbeta_metrics", _AT), T.StructField("topk_metrics", _AT)]
    + [T.StructField(c, T.DoubleType()) for c in ("brier", "brier_pos", "brier_neg", "ece_at_k")]
)


def threshold_report(validation: DataFrame, test: DataFrame, k: int, beta: float, calibration: str, bins: int = 10, **kw) -> DataFrame:
    """Thresholds chosen on validation and both splits' metrics at them, as one nested row.

    Both splits collapse to one stored table of counts per score, and everything
    comes from it. Rows are read once more for the score at which a split's k best
    rows end only, where the key decides which of them belong. Rows without a
    finite score count in ``support`` alone.
    """
    target, score, key = kw.get("target", "target"), kw.get("score", "score"), kw.get("key", "row_key")
    splits = {"validation": validation, "test": test}
    counts = report_counts(splits, target, score)
    sums = {name: cut(_running(counts.where((F.col("split") == name) & is_finite(F.col("score"))).drop("split"))) for name in splits}
    ends = {name: _kth_score(cum, int(k)) for name, cum in sums.items()}
    t_f = sums["validation"].agg(_best_fbeta(beta)[0]).first()[0]
    t_k = ends["validation"][0] if ends["validation"] else 1.0
    at = threshold_metrics(counts, {"fbeta": t_f, "topk": t_k}, beta)
    empty = {name: _at((0, 0), (0, 0), t, beta) for name, t in (("fbeta", t_f), ("topk", t_k))}

    def tied(name: str) -> int:
        if ends[name] is None:
            return 0
        end, n = ends[name]
        picked = splits[name].where(F.col(score).cast("double") == F.lit(end)).select(key, target).orderBy(key).limit(n)  # n <= k
        return picked.agg(F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0))).first()[0]

    blocks = [_block(sums[name], ends[name], tied(name), at.get(name, empty), bins) for name in splits]
    fields = [
        T.StructField("calibration_method", T.StringType()),
        T.StructField("fbeta_beta", T.DoubleType()),
        T.StructField("fbeta_threshold", T.DoubleType()),
        T.StructField("top_k_threshold", T.DoubleType()),
        T.StructField("k", T.LongType()),
        *[T.StructField(name, _BLOCK) for name in splits],
    ]
    return validation.sparkSession.createDataFrame([(calibration, float(beta), float(t_f), float(t_k), int(k), *blocks)], T.StructType(fields))
