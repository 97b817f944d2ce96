"""Splits by date, expanding time folds, stratified folds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.functions.dates import literal_like
from leadspark.operators.ranking import ROWS_PER_BUCKET, hash_ranked, with_rank

MAX_DATES = 10_000
#: Rows of a class that are ordered together; a class is dealt out by its hash, so that its rows do not meet in one task.
ROWS_PER_SLICE = 20_000


def distinct_dates(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(date).isNotNull()).select(date).distinct()


def split_dates(df: DataFrame, date: str = "snapshot_date") -> list:
    """Sorted distinct dates; fewer than three, or more than ``MAX_DATES``, is an error."""
    dates = sorted(r[0] for r in distinct_dates(df, date).take(MAX_DATES + 1))
    if len(dates) > MAX_DATES:
        raise ValueError(f"more than {MAX_DATES} distinct values in {date}: not a snapshot column")
    if len(dates) < 3:
        raise ValueError("need at least 3 distinct snapshot dates for train, validation and test")
    return dates


def on_dates(df: DataFrame, dates: list, date: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(date).isin(*[literal_like(df, date, d) for d in dates]))


def with_split(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Last date is the test split, the one before validation, all earlier ones training."""
    dates = split_dates(df, date)
    d, test, val = F.col(date), literal_like(df, date, dates[-1]), literal_like(df, date, dates[-2])
    return df.withColumn("split", F.when(d == test, "test").when(d == val, "val").when(d.isNotNull(), "train"))


def split_by_dates(df: DataFrame, date: str = "snapshot_date") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test); plain date filters, so partition pruning applies."""
    dates = split_dates(df, date)
    return on_dates(df, dates[:-2], date), on_dates(df, dates[-2:-1], date), on_dates(df, dates[-1:], date)


def samples_per_month_gap(df: DataFrame, months_gap: int = 2, date: str = "snapshot_date") -> DataFrame:
    """Months of gap as a number of rows, within [100, 2000]."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.date_trunc("month", date)).alias("n_months")).select(
        "n_rows",
        "n_months",
        F.floor(
            F.greatest(F.lit(100.0), F.least(F.lit(months_gap) * (F.col("n_rows") / F.greatest("n_months", F.lit(1))), F.lit(2000.0)))
        ).alias("gap"),
    )


def gap_rows(df: DataFrame, months_gap: int = 2, date: str = "snapshot_date") -> int:
    return int(samples_per_month_gap(df, months_gap, date).first()["gap"])


@dataclass(frozen=True)
class TimeFold:
    """Half-open position ranges; training ends ``gap`` rows before the test rows."""

    fold: int
    train_end: int
    test_start: int
    test_end: int

    def train(self, position: str = "position") -> Column:
        return F.col(position) < self.train_end

    def test(self, position: str = "position") -> Column:
        return (F.col(position) >= self.test_start) & (F.col(position) < self.test_end)


def time_folds(n: int, n_splits: int = 4, gap: int = 0) -> list[TimeFold]:
    """Expanding-window folds over n chronological positions."""
    size = n // (n_splits + 1)
    if size == 0 or n - gap - size * n_splits <= 0:
        raise ValueError(f"{n} rows are too few for {n_splits} time folds with a gap of {gap}")
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    return [TimeFold(i, s - gap, s, s + size) for i, s in enumerate(starts)]


def date_folds(dates: list, n_splits: int = 4, months_gap: int = 2, date: str = "snapshot_date") -> list[tuple[Column, Column]]:
    """(training, test) conditions of expanding folds by date, whatever the number of rows.

    Each of the last ``n_splits`` dates is tested on its own; training ends
    ``months_gap`` months before it. Dates with nothing to train on are no fold.
    """
    folds = []
    for i, d in enumerate(dates):
        bound = F.add_months(F.lit(d).cast("date"), -months_gap)
        if any(_months_between(d, e) >= months_gap for e in dates[:i]):
            folds.append((F.col(date).cast("date") <= bound, F.col(date).cast("date") == F.lit(d).cast("date")))
    if not folds:
        raise ValueError(f"no date has training rows {months_gap} months before it")
    return folds[-n_splits:]


def _months_between(later, earlier) -> int:
    """Whole months from one date to a later one."""
    return (later.year - earlier.year) * 12 + later.month - earlier.month - (later.day < earlier.day)


def with_position(df: DataFrame, key: str = "company_id", date: str = "snapshot_date", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """0-based position in (date, company) order."""
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    ranked = with_rank(df, day, F.col(key), "position", rows_per_bucket)
    return ranked.withColumn("position", F.col("position") - 1)


def stratified_folds(df: DataFrame, k: int, target: str = "target", key: str = "row_key", seed: int = 42, rows_per_bucket: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``fold`` 0..k-1: shuffled, with each class spread evenly to within one row."""
    ranked = hash_ranked(df, F.col(key), seed, [target], rows_per_bucket)
    return ranked.withColumn("fold", (F.col("hash_rank") - 1) % k).drop("hash_rank")


def chronological(df: DataFrame) -> DataFrame:
    """Order by snapshot and company where those columns exist; for sinks only."""
    if "snapshot_date" not in df.columns:
        return df
    return df.orderBy(*[c for c in ("snapshot_date", "company_id") if c in df.columns])
