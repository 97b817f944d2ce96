"""Stratified and class-balanced sampling with exact quotas."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadspark.functions.features import concat_key, grouped_value
from leadspark.functions.hashing import SPACE, hash32
from leadspark.operators.ranking import hash_quota
from leadspark.session import cut

# Cantons and legal forms kept as strata of their own; segments whose positives are preserved.
MAJOR_CANTONS = ("ZH", "BE", "VD", "GE", "AG", "SG", "TI", "VS", "LU", "ZG")
MAJOR_LEGAL_FORMS = ("Einzelunternehmen", "GmbH", "Aktiengesellschaft", "Verein", "Genossenschaft")
LARGE_SIZES = ("GROSS", "SEHR GROSS", "MITTEL")
BIG_CANTONS = ("ZH", "BE", "VD", "GE", "AG")
#: Standard deviations to each side of the expected place of a bag's end in which its rows are kept.
WINDOW_SPREADS = 6.0


def strata_columns(
    df: DataFrame, target: str, major_cantons: tuple[str, ...] = MAJOR_CANTONS, major_forms: tuple[str, ...] = MAJOR_LEGAL_FORMS
) -> list[Column]:
    """The sampling dimensions that exist in the frame."""
    have = set(df.columns)
    cols = [F.col(target)]
    if "canton" in have:
        cols.append(grouped_value(F.col("canton"), major_cantons))
    if "size_class" in have:
        cols.append(F.col("size_class"))
    if "snapshot_date" in have:
        cols.append(F.year("snapshot_date"))
    if "legal_form" in have:
        cols.append(grouped_value(F.col("legal_form"), major_forms))
    return cols


def with_stratum(df: DataFrame, target: str, **groups) -> DataFrame:
    return df.withColumn("stratum", concat_key(*strata_columns(df, target, **groups)))


def strata_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("stratum").agg(F.count(F.lit(1)).alias("size"))


def strata_quotas(sizes: DataFrame, max_samples: int) -> DataFrame:
    """Rows to keep per stratum: proportional, at least a tenth of an equal share, reduced if the sum is too large.

    Strata are combinations of a few coarse dimensions, so the unpartitioned
    window sees a bounded number of rows.
    """
    all_strata = Window.partitionBy()
    n, g = F.sum("size").over(all_strata), F.count(F.lit(1)).over(all_strata)
    floor_share = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(float(max_samples)) / g * 0.1))
    want = F.greatest(floor_share, F.floor(F.col("size") * (F.lit(float(max_samples)) / n)))
    first = sizes.withColumn("first_quota", F.least(want, F.col("size"))).withColumn("rows", n)
    total = F.sum("first_quota").over(all_strata)
    reduced = F.greatest(F.lit(1).cast("long"), F.floor(F.col("first_quota") * (F.lit(float(max_samples)) / total)))
    final = F.when(total > max_samples, F.least(reduced, F.col("first_quota"))).otherwise(F.col("first_quota"))
    return first.withColumn("quota", F.when(F.col("rows") <= max_samples, F.col("size")).otherwise(final)).select("stratum", "size", "first_quota", "quota")


def stratified_sample(df: DataFrame, max_samples: int, target: str = "target", key: str = "row_key", seed: int = 42, **groups) -> DataFrame:
    """Sample to about ``max_samples`` rows keeping every stratum; small frames come back whole."""
    if df.count() <= max_samples:
        return df
    marked = with_stratum(df, target, **groups)
    quotas = strata_quotas(strata_sizes(marked), max_samples)
    return hash_quota(marked, F.col(key), seed, ["stratum"], quotas).drop("stratum")


def preserved_positives(
    df: DataFrame,
    target: str = "target",
    key: str = "row_key",
    big_cantons: tuple[str, ...] = BIG_CANTONS,
    limit: int | None = None,
    keep_duplicates: bool = False,
) -> DataFrame:
    """Positives of larger companies, and those outside the big cantons: all, or the first ``limit``.

    A null canton counts as outside. A company in both sets appears once, or
    twice with ``keep_duplicates``.
    """
    positives = df.where(F.col(target) == 1)
    large = positives.where(F.col("size_class").isin(*LARGE_SIZES)) if "size_class" in df.columns else positives.limit(0)
    if "canton" not in df.columns:
        return large
    outside = ~F.coalesce(F.col("canton").isin(*big_cantons), F.lit(False))
    order = [c for c in ("snapshot_date",) if c in df.columns] + [key]
    small = positives.where(outside)
    small = small if limit is None else small.orderBy(*order).limit(limit)
    both = large.unionByName(small)
    return both if keep_duplicates else both.dropDuplicates([key])


def business_sample(
    df: DataFrame,
    max_samples: int,
    target: str = "target",
    key: str = "row_key",
    seed: int = 42,
    keep_duplicates: bool = False,
    big_cantons: tuple[str, ...] = BIG_CANTONS,
    preserve_rare_positives: bool = True,
    limit: int | None = None,
    **groups,
) -> DataFrame:
    """Preserved positives plus a stratified sample of the rest within the remaining budget."""
    if df.count() <= max_samples:
        return df
    if not preserve_rare_positives:
        return stratified_sample(df, max_samples, target, key, seed, **groups)
    rare = cut(preserved_positives(df, target, key, big_cantons, limit, keep_duplicates))
    budget = max_samples - rare.count()
    if budget <= 0:
        return rare
    rest = df.join(rare.select(key).distinct(), key, "left_anti")
    return rare.unionByName(stratified_sample(rest, budget, target, key, seed, **groups))


def distribution_shift(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Share of every value before and after sampling and the difference in points."""
    shares = []
    for name, df in (("before_pct", before), ("after_pct", after)):
        counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        total = F.sum("n").over(Window.partitionBy())  # one row per distinct value
        shares.append(counts.where(F.col("value").isNotNull()).withColumn(name, F.col("n") * 100.0 / total).select("value", name))
    joined = shares[0].join(shares[1], "value", "full").fillna(0.0, ["before_pct", "after_pct"])
    return joined.withColumn("diff_points", F.abs(F.col("before_pct") - F.col("after_pct")))


def balanced_bag(
    df: DataFrame, bag: int, target: str = "target", key: str = "row_key", seed: int = 42, ratio: float = 1.0
) -> DataFrame:
    """The whole smaller class and a random draw from the larger one, ``ratio`` = smaller / larger."""
    counts = {int(r[target]): r["count"] for r in df.groupBy(target).count().collect()}
    if len(counts) < 2:
        return df
    small = min(counts, key=lambda c: (counts[c], c))
    want = int(counts[small] / ratio)
    larger = hash_quota(df.where(F.col(target) != small), F.col(key), seed + bag, [], want)
    return df.where(F.col(target) == small).unionByName(larger)


@dataclass(frozen=True)
class Bags:
    """Balanced bags of a stored frame: all rows of the smaller class, and of the larger one those up to a place in each bag's hash order."""

    df: DataFrame
    target: str
    key: str
    seed: int
    small: int | None = None
    ends: tuple[tuple[int, int] | None, ...] = ()

    def members(self, bag: int) -> Column:
        """Whether a row is in the bag: a comparison of its own hash, so no join and no shuffle."""
        if self.small is None:
            return F.lit(True)
        own, end = F.col(self.target) == self.small, self.ends[bag]
        if end is None:
            return own
        h = hash32(F.col(self.key), self.seed + bag)
        return own | (h < F.lit(end[0])) | ((h == F.lit(end[0])) & (F.col(self.key) <= F.lit(end[1])))

    def rows(self, bag: int) -> DataFrame:
        return self.df.where(self.members(bag))


def balanced_bags(
    df: DataFrame, n_bags: int, target: str = "target", key: str = "row_key", seed: int = 42, ratio: float = 1.0, spreads: float = WINDOW_SPREADS
) -> Bags:
    """The bags of ``balanced_bag`` with numbers 0 to ``n_bags`` - 1, drawn together in two passes over the rows.

    The first pass counts the classes. Hashes are uniform, so the place at which a
    bag's quota ends is known within some standard deviations; the second pass
    counts, for all bags at once, the rows before that window and keeps the rows
    inside it, about the square root of the class. A bag whose end lies outside
    its window is drawn by ``hash_quota`` on its own. Keys are unique; rows that
    repeat a key go together.
    """
    df = cut(df)
    counts = {int(r[target]): r["count"] for r in df.groupBy(target).count().collect()}
    if len(counts) < 2:
        return Bags(df, target, key, seed, None, (None,) * n_bags)
    small = min(counts, key=lambda c: (counts[c], c))
    n = sum(c for v, c in counts.items() if v != small)
    want = min(int(counts[small] / ratio), n)
    if want <= 0:
        return Bags(df, target, key, seed, small, (None,) * n_bags)
    half = spreads * math.sqrt(want * (n - want) / n) + spreads
    lo, hi = (int(min(max((want + d) / n, 0.0), 1.0) * SPACE) for d in (-half, half))
    larger = df.where(F.col(target) != small)
    drawn = F.array(*[F.struct(F.lit(b).alias("bag"), hash32(F.col(key), seed + b).alias("h")) for b in range(n_bags)])
    seen = larger.select(F.col(key).alias("k"), F.explode(F.filter(drawn, lambda x: x["h"] < F.lit(hi))).alias("x"))
    inside = F.col("x.h") >= F.lit(lo)  # rows before the window become one count a bag and task
    window = cut(seen.groupBy(F.col("x.bag").alias("bag"), F.when(inside, F.col("x.h")).alias("h"), F.when(inside, F.col("k")).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    before = {r["bag"]: r["n"] for r in window.where(F.col("h").isNull()).collect()}
    order = Window.partitionBy("bag").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.element_at(F.create_map(*[F.lit(x).cast("long") for b in range(n_bags) for x in (b, before.get(b, 0))]), F.col("bag").cast("long"))
    reached = window.where(F.col("h").isNotNull()).withColumn("upto", start + F.sum("n").over(order))
    ends = {r["bag"]: (r["h"], r["k"]) for r in reached.where(F.col("upto") == want).select("bag", "h", "k").collect()}  # one row a bag
    for b in range(n_bags):
        if b not in ends:
            last = hash_quota(larger, F.col(key), seed + b, [], want).agg(F.max(F.struct(hash32(F.col(key), seed + b), F.col(key)))).first()[0]
            ends[b] = (last[0], last[1])
    return Bags(df, target, key, seed, small, tuple(ends[b] for b in range(n_bags)))


def parse_sampling_strategy(value):
    """A number, or one of the words auto, minority, majority; numbers may come as text."""
    if value is None or isinstance(value, (int, float)):
        return value
    text = str(value).strip().lower()
    if text in ("auto", "minority", "majority"):
        return text
    try:
        return float(text)
    except ValueError:
        return value


def smote(
    df: DataFrame,
    vector: str = "features",
    target: str = "target",
    key: str = "row_key",
    ratio: float = 0.1,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Synthetic minority rows (Chawla et al. 2002) until minority / majority reaches ``ratio``.

    Returns (key, vector, target, synthetic). Base rows take turns; neighbour and
    position between base and neighbour come from the hash, so a rerun gives the
    same rows. Synthetic keys are negative 62-bit hashes of base key and copy,
    whatever the size of the keys. ``vector`` is an array of doubles.
    """
    from leadspark.functions.hashing import unit_hash
    from leadspark.operators.lookalike import nearest

    counts = {int(r[target]): r["count"] for r in df.groupBy(target).count().collect()}
    original = df.select(key, F.col(vector).cast("array<double>").alias(vector), target).withColumn("synthetic", F.lit(False))
    n_min, n_maj = counts.get(1, 0), counts.get(0, 0)
    extra = int(ratio * n_maj) - n_min
    if extra <= 0 or n_min < 2:
        return original
    minority = cut(original.where(F.col(target) == 1).select(key, vector))
    k = min(k, n_min - 1)
    near = nearest(minority, minority, vector, key, key, k, exclude_self=True)
    each, one_more = divmod(extra, n_min)
    if one_more:
        lucky = hash_quota(minority.select(key), F.col(key), seed, [], one_more).withColumn("_extra", F.lit(1))
        counted = near.join(lucky, key, "left")
    else:
        counted = near.withColumn("_extra", F.lit(0))
    times = F.lit(each) + F.coalesce(F.col("_extra"), F.lit(0))
    copies = counted.where(times > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    draw = F.pmod(F.xxhash64(key, "_copy"), F.lit(1 << 62))
    picks = copies.select(
        key,
        F.element_at("neighbour_ids", (hash32(draw, seed + 1) % k + 1).cast("int")).alias("_other"),
        unit_hash(draw, seed + 2).alias("_u"),
        "_copy",
    )
    pairs = picks.join(minority, key).join(
        minority.select(F.col(key).alias("_other"), F.col(vector).alias("_ov")), "_other"
    )
    point = F.zip_with(vector, "_ov", lambda a, b: a + F.col("_u") * (b - a))
    made = pairs.select(
        (-F.pmod(F.xxhash64(key, "_copy"), F.lit(1 << 62)) - 1).alias(key), point.alias(vector), F.lit(1).cast(df.schema[target].dataType).alias(target), F.lit(True).alias("synthetic")
    )
    return original.unionByName(made)
