"""Monthly commercial-register cube and the views a dashboard reads from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date, month_start
from leadspark.session import cut

# Event types, the difference of both, and the two geographic levels.
ENTRY = "HR01"
DELETION = "HR03"
NET = "NET"
METRICS = (ENTRY, DELETION, NET)
COUNTRY = "CH"
CANTON = "KT"


def normalise(events: DataFrame) -> DataFrame:
    """Month start, upper-case canton and event type.

    ``publications`` says how many events a row stands for; without it each row is one.
    """
    n = F.col("publications") if "publications" in events.columns else F.lit(1).cast("long")
    return events.select(
        month_start(F.col("publication_date")).alias("month"),
        F.upper(F.trim("kanton")).alias("kanton"),
        F.upper("shab_id").alias("shab_id"),
        n.alias("publications"),
    )


def counts_by_canton(events: DataFrame) -> DataFrame:
    return normalise(events).groupBy("month", "kanton", "shab_id").agg(F.sum("publications").alias("count"))


def monthly_counts(events: DataFrame) -> DataFrame:
    """Counts per canton and for the country, both levels from one aggregation.

    Events without a canton count for the country only.

    The country level is rolled up from the canton counts, so rows are read once
    and no level is expanded row by row.
    """
    levels = counts_by_canton(events).groupingSets([["month", "kanton", "shab_id"], ["month", "shab_id"]], "month", "kanton", "shab_id").agg(
        F.sum("count").alias("count"), F.grouping("kanton").alias("_total")
    )
    return levels.where((F.col("_total") == 1) | F.col("kanton").isNotNull()).select(
        "month",
        F.when(F.col("_total") == 1, COUNTRY).otherwise(CANTON).alias("geo"),
        "kanton",
        "shab_id",
        "count",
    )


def by_type(counts: DataFrame) -> DataFrame:
    """One column per event type, 0 where a type does not occur, and their difference."""
    wide = counts.groupBy("month", "geo", "kanton").pivot("shab_id", [ENTRY, DELETION]).sum("count").fillna(0, [ENTRY, DELETION])
    return wide.withColumn(NET, F.col(ENTRY) - F.col(DELETION))


def net_long(wide: DataFrame) -> DataFrame:
    """The difference back in long form."""
    return wide.unpivot(["month", "geo", "kanton"], [NET], "shab_id", "count")


def monthly_cube(events: DataFrame) -> DataFrame:
    """(month, geo, kanton, hr, count) with all metrics; the sinks order it."""
    counts = monthly_counts(events)
    cube = counts.unionByName(net_long(by_type(counts)))
    return cube.select(iso_date(F.col("month")).alias("month"), "geo", "kanton", F.col("shab_id").alias("hr"), "count")


def ordered_cube(cube: DataFrame) -> DataFrame:
    return cube.orderBy("month", "geo", F.col("kanton").asc_nulls_last(), "hr")


def dimensions(cube: DataFrame) -> DataFrame:
    """One row of sorted arrays: metrics, cantons, months."""
    return cube.agg(
        F.array(*[F.lit(m) for m in METRICS]).alias("metrics"),
        F.array_sort(F.collect_set("kanton")).alias("cantons"),
        F.array_sort(F.collect_set("month")).alias("months"),
    )


def status(cube: DataFrame) -> DataFrame:
    return cube.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("month").alias("months_covered"),
        F.countDistinct("kanton").alias("cantons_covered"),
    )


def visible_months(cube: DataFrame, last_n: int = 0) -> DataFrame:
    """The last N months that occur; 0 means all."""
    months = cube.select("month").distinct()
    if last_n <= 0:
        return months
    return months.orderBy(F.col("month").desc()).limit(last_n)


def month_positions(cube: DataFrame) -> DataFrame:
    """Months with their position counted from the latest."""
    from_end = Window.orderBy(F.col("month").desc())  # one row per month
    return cube.select("month").distinct().select("month", F.dense_rank().over(from_end).alias("position"))


def dashboard_rows(cube: DataFrame, metric: str, last_n: int = 0, geo: str = COUNTRY, kanton: str | None = None) -> DataFrame:
    """Rows of one metric at one level in the visible months."""
    rows = cube.where((F.col("geo") == geo) & (F.col("hr") == metric))
    if kanton is not None:
        rows = rows.where(F.col("kanton") == kanton)
    return rows.join(visible_months(cube, last_n), "month", "left_semi")


def time_series(cube: DataFrame, metric: str, last_n: int = 0, geo: str = COUNTRY, kanton: str | None = None) -> DataFrame:
    """The chosen series over all visible months, 0 where it has no row."""
    rows = dashboard_rows(cube, metric, 0, geo, kanton).select("month", "count")
    return visible_months(cube, last_n).join(rows, "month", "left").fillna(0, ["count"])


def heat_map(cube: DataFrame, metric: str, last_n: int = 0) -> DataFrame:
    """Every canton in every visible month, 0 where there is no row."""
    cube = cut(cube)  # one row a month, canton and type; read three times below
    rows = dashboard_rows(cube, metric, 0, CANTON).select("kanton", "month", "count")
    months = [r[0] for r in visible_months(cube, last_n).collect()]  # one a calendar month
    cantons = cube.where(F.col("kanton").isNotNull()).select("kanton").distinct()
    grid = cantons.withColumn("month", F.explode(F.array(*[F.lit(m) for m in months]).cast("array<string>")))
    return grid.join(rows, ["kanton", "month"], "left").fillna(0, ["count"])
