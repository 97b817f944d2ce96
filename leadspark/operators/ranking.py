"""Global order without a global task: ranks, running sums, quantile groups, exact quantiles.

Rows are put into buckets that follow the order (value, key). The bucket edges
come from a bounded hash sample; each bucket sorts on its own and starts from the
totals of the buckets before it. Edges only steer the load: whatever the sample
says, ranks and sums are exact. A value that holds a large share of all rows is
split further along the key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadspark.functions.features import is_finite
from leadspark.functions.hashing import SPACE, hash32
from leadspark.operators.lookup import lookup_join
from leadspark.session import cut, scratch_path

ROWS_PER_BUCKET = 500_000
#: Rows drawn for each bucket's edge, fewer where there are very many buckets.
SAMPLE_PER_BUCKET = 200
SAMPLE_ROWS = 4_000_000
LEAST_PER_BUCKET = 16
#: Quotas: bits of the hash by which slices are cut at a time, and rows that the last slice of a group may hold.
HASH_BITS = (12, 12, 8)
EDGE_ROWS = 200_000
#: Quantile search: values that one rank's last interval may hold, sketched values of an interval, and the sketch's accuracy.
KEPT_VALUES = 2_000
STEPS = 128
ACCURACY = 4_096
#: Values of an interval that are sketched; of more a random share.
SKETCHED = 100_000


def _double_array(values: np.ndarray) -> Column:
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _edge_index(df: DataFrame, source: str, edges: np.ndarray, out: str) -> DataFrame:
    """Number of edges that are <= the value, by binary search in the JVM."""
    splits = [float("-inf"), *map(float, edges), float("inf")]
    return Bucketizer(splits=splits, inputCol=source, outputCol=out).transform(df).withColumn(out, F.col(out).cast("long"))


def with_order_bucket(
    df: DataFrame, value: Column, key: Column, rows_per_bucket: int = ROWS_PER_BUCKET, n: int | None = None
) -> tuple[DataFrame, int]:
    """Add ``_v``, ``_k`` and ``_bucket``; the bucket never decreases along (value, key).

    Rows without a finite value are left out; ``n`` is the row count where it is known. Returns the frame and the number of buckets aimed at.
    """
    base = df.withColumns({"_v": value.cast("double") + F.lit(0.0), "_k": key.cast("double") + F.lit(0.0)}).where(is_finite(F.col("_v")))
    n = base.count() if n is None else n
    m = -(-n // rows_per_bucket)
    if m <= 1:
        return base.withColumn("_bucket", F.lit(0).cast("long")), 1
    each = max(LEAST_PER_BUCKET, min(SAMPLE_PER_BUCKET, SAMPLE_ROWS // m))
    share = min(1.0, each * m / n)
    # by value and key together: a constant key, or one value for all, still gives its share of rows
    spot = F.pmod(F.xxhash64("_v", "_k"), F.lit(SPACE))
    drawn = base.where(spot < F.lit(int(share * SPACE))).select("_v", "_k").limit(2 * each * m).toPandas()
    drawn = drawn.sort_values(["_v", "_k"], ignore_index=True)
    if len(drawn) < m:
        picks = drawn
    else:
        picks = drawn.iloc[(np.arange(1, m) * len(drawn)) // m]
    if picks.empty:
        return base.withColumn("_bucket", F.lit(0).cast("long")), 1
    edges, repeats = np.unique(picks["_v"].to_numpy(), return_counts=True)
    heavy = repeats >= max(2, m // 256)
    out = _edge_index(base, "_v", edges, "_i")
    at_edge = (F.col("_i") > 0) & (F.element_at(_double_array(edges), F.greatest(F.col("_i"), F.lit(1)).cast("int")) == F.col("_v"))
    place = F.col("_i") * 2 - at_edge.cast("long")
    if not heavy.any():
        return out.withColumn("_bucket", place).drop("_i"), m
    key_edges = np.unique(picks["_k"].to_numpy()[np.isin(picks["_v"].to_numpy(), edges[heavy])])
    out = _edge_index(out, "_k", key_edges, "_j")
    is_heavy = F.element_at(_double_array(heavy.astype(float)), F.greatest(F.col("_i"), F.lit(1)).cast("int")) == 1.0
    part = F.when(at_edge & is_heavy, F.col("_j")).otherwise(F.lit(0))
    return out.withColumn("_bucket", place * F.lit(len(key_edges) + 1) + part).drop("_i", "_j"), m


def running_sums(
    df: DataFrame, value: Column, key: Column, sums: dict[str, Column], rows_per_bucket: int = ROWS_PER_BUCKET, n: int | None = None
) -> DataFrame:
    """Inclusive running sums along (value asc, key asc) over all rows with a finite value."""
    cols = df.columns
    bucketed, buckets = with_order_bucket(df.withColumns({f"_s_{k}": c for k, c in sums.items()}).withColumn("_key", key), value, F.col("_key"), rows_per_bucket, n=n)
    w = Window.partitionBy("_bucket").orderBy("_v", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.withColumns({f"_l_{k}": F.sum(f"_s_{k}").over(w) for k in sums})
    if buckets == 1:
        return local.select(*cols, *[F.col(f"_l_{k}").alias(k) for k in sums])
    totals = bucketed.groupBy("_bucket").agg(*[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket, bounded
    starts = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    return local.join(F.broadcast(starts), "_bucket").select(*cols, *[(F.col(f"_l_{k}") + F.col(f"_o_{k}")).alias(k) for k in sums])


def with_rank(
    df: DataFrame, order: Column, key: Column, out: str = "rank", rows_per_bucket: int = ROWS_PER_BUCKET, n: int | None = None
) -> DataFrame:
    """1..n along (order asc, key asc); rows without a finite value are left out. Negate a score to rank it from the top."""
    return running_sums(df, order, key, {out: F.lit(1).cast("long")}, rows_per_bucket, n)


def quantile_group(rank: Column, n: Column | int, groups: int) -> Column:
    """Group 1..groups of a rank 1..n, right-closed at linear quantile edges."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    rank = rank.cast("long")
    inner = F.floor(((rank - 1) * groups + n - 2) / F.greatest(n - 1, F.lit(1))).cast("long")
    return F.when(n <= 1, F.lit(1).cast("long")).otherwise(F.greatest(F.lit(1).cast("long"), inner))


def rank_leads(scored: DataFrame, score: str = "p_convert", key: str = "company_id", groups: int = 10, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rank from the best score down and put the ranks into deciles. Rows without a finite score are left out."""
    scored = scored.where(is_finite(F.col(score)))
    n = scored.count()
    ranked = with_rank(scored, -F.col(score), F.col(key), rows_per_bucket=rows_per_bucket, n=n)
    return ranked.withColumn("decile", quantile_group(F.col("rank"), n, groups))


def average_rank_share(df: DataFrame, score: str, out: str = "p_rank", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Average rank from the lowest score up, divided by the number of rows.

    Ranks are worked out once per distinct score; rows then look theirs up. Rows
    without a finite score are not counted and get no rank.
    """
    counts = cut(df.where(is_finite(F.col(score))).groupBy(score).agg(F.count(F.lit(1)).alias("_c")))  # read several times below
    n = counts.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    cum = running_sums(counts, F.col(score), F.lit(0), {"_upto": F.col("_c")}, rows_per_bucket)
    share = cum.select(score, ((F.col("_upto") - F.col("_c") + (F.col("_c") + 1) / 2) / F.lit(float(n))).alias(out))
    return lookup_join(df, share, score)


def top_k(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k best rows with a finite score; ties go to the lower key."""
    return df.where(is_finite(F.col(score))).orderBy(F.col(score).desc(), F.col(key).asc()).limit(max(int(k), 0))


def hash_ranked(df: DataFrame, key: Column, seed: int, groups: list[str], rows_per_bucket: int = ROWS_PER_BUCKET, out: str = "hash_rank") -> DataFrame:
    """1..n within each group in hash order.

    Hashes are uniform, so equal slices of the hash range split even a group that
    holds most rows into tasks of like size.
    """
    n = df.count()
    slices = int(min(65536, max(1, -(-n // rows_per_bucket))))
    base = df.withColumns({"_h": hash32(key, seed), "_key": key})
    base = base.withColumn("_slice", F.floor(F.col("_h") * slices / F.lit(SPACE)).cast("long"))
    w = Window.partitionBy(*groups, "_slice").orderBy("_h", "_key")
    local = base.withColumn("_r", F.row_number().over(w).cast("long"))
    if slices == 1:
        return local.withColumn(out, F.col("_r")).drop("_h", "_key", "_slice", "_r")
    sizes = base.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*groups, "_slice", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    joined = local.join(starts, [*groups, "_slice"])
    return joined.withColumn(out, F.col("_r") + F.col("_o")).select(*df.columns, out)


def _quota_cuts(base: DataFrame, groups: list[str], quotas: DataFrame | int, bits: tuple[int, ...], edge_rows: int) -> DataFrame:
    """Per group: the hash slice ``_lo`` to ``_hi`` in which the quota ``_q`` ends, and the ``_below`` rows before it.

    The slice is cut finer, by so many bits at a time, until it holds at most ``edge_rows`` rows in every group.
    """
    counted, width = base, SPACE >> bits[0]
    place = F.floor(F.col("_h") / F.lit(width)).cast("long")
    upto = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = None
    for level, more in enumerate(bits):
        sizes = counted.groupBy(*groups, place.alias("_slice")).agg(F.count(F.lit(1)).alias("_c"))
        running = sizes.withColumn("_upto", F.sum("_c").over(upto))  # at most 2 ** bits rows per group
        if cuts is None:
            known = quotas.select(*groups, F.col("quota").cast("long").alias("_q"), F.lit(0).cast("long").alias("_base")) if groups else None
            running = running.join(known, groups) if groups else running.withColumns({"_q": F.lit(int(quotas)).cast("long"), "_base": F.lit(0).cast("long")})
        else:
            known = cuts.select(*groups, "_q", F.col("_below").alias("_base"))
            running = running.join(known, groups) if groups else running.crossJoin(F.broadcast(known))  # one row
        within = F.col("_upto") + F.col("_base") <= F.col("_q")
        found = running.groupBy(*groups).agg(
            F.coalesce(F.min(F.when(~within, F.col("_slice"))), F.lit(1 << sum(bits[: level + 1]))).cast("long").alias("_slice"),
            (F.coalesce(F.max(F.when(within, F.col("_upto"))), F.lit(0)) + F.max("_base")).alias("_below"),
            F.max("_q").alias("_q"),
            F.coalesce(F.min_by("_c", F.when(~within, F.col("_slice"))), F.lit(0)).alias("_edge"),
        )
        found = found.select(*groups, (F.col("_slice") * width).alias("_lo"), ((F.col("_slice") + 1) * width).alias("_hi"), "_below", "_q", "_edge")
        # a group whose quota was not reached has its cut at the end of the slice that was counted
        cuts = cut(found if cuts is None else _within(found, cuts, groups))
        largest = cuts.agg(F.max("_edge")).first()[0] or 0
        if level + 1 == len(bits) or largest <= edge_rows:
            return cuts
        width >>= bits[level + 1]
        edge = lookup_join(base, cuts.select(*groups, "_lo", "_hi"), groups, "inner") if groups else base.crossJoin(F.broadcast(cuts.select("_lo", "_hi")))  # one row
        counted = edge.where((F.col("_h") >= F.col("_lo")) & (F.col("_h") < F.col("_hi"))).select(*groups, "_h")
        place = F.floor(F.col("_h") / F.lit(width)).cast("long")


def _within(found: DataFrame, cuts: DataFrame, groups: list[str]) -> DataFrame:
    """The finer cuts, and the old ones of groups that have no rows in their slice; no cut leaves its old slice."""
    old = cuts.select(*groups, F.col("_lo").alias("_a"), F.col("_hi").alias("_b"), F.col("_below").alias("_old"), F.col("_q").alias("_oq"))
    both = old.join(found, groups, "left") if groups else old.join(found, how="left")
    lo = F.least(F.coalesce("_lo", "_b"), F.col("_b"))
    return both.select(*groups, lo.alias("_lo"), F.least(F.coalesce("_hi", "_b"), F.col("_b")).alias("_hi"), F.coalesce("_below", "_old").alias("_below"), F.col("_oq").alias("_q"), F.coalesce("_edge", F.lit(0)).alias("_edge"))


def hash_quota(df: DataFrame, key: Column, seed: int, groups: list[str], quotas: DataFrame | int, bits: tuple[int, ...] = HASH_BITS, edge_rows: int = EDGE_ROWS) -> DataFrame:
    """The rows with the lowest hash in each group, exactly as many as its quota.

    ``quotas`` has the group columns and ``quota``, or is one number where there
    are no groups. Only the hash slice in which a quota ends is ordered, and that
    slice is refined until it holds at most ``edge_rows`` rows; all other rows
    are kept or dropped by their hash alone, without a shuffle. A group without a
    quota keeps nothing.
    """
    base = df.withColumns({"_h": hash32(key, seed), "_key": key})
    cuts = _quota_cuts(base, groups, quotas, bits, edge_rows).drop("_edge")
    if groups:
        marked = lookup_join(base, cuts, groups, "inner")
    else:
        one = cuts.first()
        marked = base.withColumns({c: F.lit((one[c] if one else 0) or 0) for c in ("_lo", "_hi", "_below", "_q")})
    sure = marked.where(F.col("_h") < F.col("_lo"))
    edge = marked.where((F.col("_h") >= F.col("_lo")) & (F.col("_h") < F.col("_hi")))
    w = Window.partitionBy(*groups, "_lo").orderBy("_h", "_key")
    edge = edge.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_q") - F.col("_below"))
    return sure.select(*df.columns).unionByName(edge.select(*df.columns))


def random_rows(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows drawn without replacement, the same on every run."""
    return hash_quota(df, key, seed, [], n)


@dataclass
class _Search:
    """Where the value of one rank lies: between ``outer`` bounds (None: open), after ``base`` values, with a narrower guess to be counted."""

    rank: int
    outer: tuple[float | None, float | None] = (None, None)
    base: int = 0
    size: int = 0
    guess: tuple[float, float] | None = None
    value: float | None = None

    def inside(self, x: Column) -> Column:
        lo, hi = self.guess or self.outer
        cond = x.isNotNull() if lo is None else x > F.lit(lo)
        return cond if hi is None else cond & (x < F.lit(hi))

    def measures(self, x: Column, keep: int, accuracy: int) -> dict[str, Column]:
        inside = F.when(self.inside(x), x)
        if self.guess is None and 0 < self.size <= keep:
            return {"all": F.sort_array(F.collect_list(inside))}  # at most ``keep`` values, counted before
        expected = self.size if self.guess is None else self.size * 4 // STEPS
        drawn = F.when(F.col("_draw") < F.lit(SKETCHED / expected), inside) if expected > SKETCHED else inside  # steers only
        edges = F.percentile_approx(drawn, F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1))), F.lit(accuracy))
        out = {"in": F.count(inside), "edges": edges}
        if self.guess is not None:
            lo, hi = self.guess
            after = x.isNotNull() if self.outer[0] is None else x > F.lit(self.outer[0])
            out |= {"below": F.count(F.when(after & (x < F.lit(lo)), x)), "low": F.count(F.when(x == F.lit(lo), x)), "high": F.count(F.when(x == F.lit(hi), x))}
        return out

    def take(self, row: dict, margin: int) -> None:
        """Narrow the search by what was counted; a sketched value may be ``margin`` steps off."""
        if "all" in row:
            self.value = row["all"][self.rank - self.base]
            return
        if self.guess is not None:
            lo, hi = self.guess
            self.guess = None
            at = self.base + row["below"]
            if self.rank < at:
                self.outer, self.size = (self.outer[0], lo), row["below"]
                return
            if self.rank < at + row["low"]:
                self.value = lo
                return
            at += row["low"]
            if self.rank >= at + row["in"]:
                if lo == hi or self.rank >= at + row["in"] + row["high"]:
                    past = row["high"] if lo != hi else 0
                    self.outer, self.base = (hi, self.outer[1]), at + row["in"] + past
                    self.size = 0
                else:
                    self.value = hi
                return
            self.outer, self.base = (lo, hi), at
        self.size = row["in"]
        edges = row["edges"]
        if edges and self.size:
            step = (self.rank - self.base) * STEPS // self.size
            self.guess = (edges[max(step - margin, 0)], edges[min(step + margin + 1, STEPS)])


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], keep: int = KEPT_VALUES, accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column; nulls and NaN are left out.

    Each needed rank is sought in an interval of values. A round is one
    aggregation for all columns: it counts what lies below, on and between the
    ends of each interval and sketches the values between, which gives the next
    interval, a few hundredths of the rows. A rank is found on an end, or among
    at most ``keep`` values; sketches only steer, counts decide.
    """
    if not cols:
        return {}
    spark = df.sparkSession
    path = scratch_path(spark, "quantiles")
    number = {c: F.col(c).cast("double") for c in cols}
    df.select(*[F.when(~F.isnan(x), x + F.lit(0.0)).alias(f"c{i}") for i, x in enumerate(number.values())]).write.parquet(path)  # read once a round
    stored = spark.read.parquet(path)
    sizes = stored.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    found: dict[str, list[float | None]] = {}
    searches: dict[str, dict[int, _Search]] = {}
    for i, c in enumerate(cols):
        n = sizes[f"c{i}"]
        ranks = {r for p in probs for r in (int(np.floor(p * (n - 1))), int(np.ceil(p * (n - 1))))} if n else set()
        searches[c] = {r: _Search(r, size=n) for r in ranks}
    while live := [(i, s) for i, c in enumerate(cols) for s in searches[c].values() if s.value is None]:
        # ranks that are still sought in the same place share their measures
        places = {(i, s.outer, s.guess, s.size): s for i, s in live}
        measures = {at: s.measures(F.col(f"c{at[0]}"), keep, accuracy) for at, s in places.items()}
        names = {at: f"m{j}_" for j, at in enumerate(measures)}
        row = stored.withColumn("_draw", F.rand(11)).agg(*[m.alias(names[at] + name) for at, own in measures.items() for name, m in own.items()]).first()
        for i, s in live:
            at = (i, s.outer, s.guess, s.size)
            s.take({name: row[names[at] + name] for name in measures[at]}, 1 + STEPS // accuracy)
    for i, c in enumerate(cols):
        n, own = sizes[f"c{i}"], searches[c]
        found[c] = []
        for p in probs:
            x = p * (n - 1)
            lo, hi = (own[int(f(x))].value for f in (np.floor, np.ceil)) if n else (None, None)
            found[c].append(None if lo is None else lo if lo == hi else lo + (hi - lo) * (x - np.floor(x)))
    return found


def ordered_index(distinct: DataFrame, col: str, out: str, partitions: int = 32) -> DataFrame:
    """0-based position of each row in the order of ``col``, for values of any type.

    Rows are range-partitioned and sorted once, written to the checkpoint folder
    so the partitions stay as they are, and numbered within their partition.
    """
    placed = cut(distinct.repartitionByRange(partitions, col).sortWithinPartitions(col))
    placed = placed.withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumns({"_p": F.shiftright("_id", 33), "_i": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    starts = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    return placed.join(F.broadcast(starts), "_p").withColumn(out, F.col("_i") + F.col("_o")).select(*distinct.columns, out)
