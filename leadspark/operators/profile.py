"""Table profile: one aggregation for all numeric, date and null statistics, one for all categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadspark.functions.features import decade
from leadspark.operators.ranking import exact_quantiles

# Postal region by leading digit of a four-digit code.
POSTAL_REGIONS = {
    1: "West (1xxx)",
    2: "West (2xxx)",
    3: "Bern (3xxx)",
    4: "Basel (4xxx)",
    5: "Aargau (5xxx)",
    6: "Central (6xxx)",
    7: "Graubünden (7xxx)",
    8: "Zurich (8xxx)",
    9: "East (9xxx)",
}
REGION_OTHER = "Other"
REGION_INVALID = "Invalid/Other"


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    kinds: dict[str, list[str]] = {"numeric": [], "string": [], "date": [], "other": []}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kinds["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            kinds["string"].append(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kinds["date"].append(f.name)
        else:
            kinds["other"].append(f.name)
    return kinds


def _per_column(stats: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """One wide row to one row per column; ``fields`` maps a column to its statistics."""
    entries = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}:{s}").alias(s) for s in names]) for c, names in fields.items()]
    return stats.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def overview(df: DataFrame) -> DataFrame:
    kinds = columns_by_kind(df)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(len(kinds["numeric"])).cast("long").alias("n_numeric"),
        F.lit(len(kinds["string"])).cast("long").alias("n_string"),
        F.lit(len(kinds["date"])).cast("long").alias("n_date"),
    )


def missing_table(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column, in one pass."""
    cols = df.columns
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"{c}:missing_count") for c in cols]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    stats = wide.withColumns({f"{c}:missing_percentage": F.col(f"{c}:missing_count") * 100.0 / F.col("n") for c in cols})
    return _per_column(stats, {c: ["missing_count", "missing_percentage"] for c in cols})


def describe_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample standard deviation, extremes and exact quartiles."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs: list[Column] = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}:count"),
            F.avg(x).alias(f"{c}:mean"),
            F.stddev_samp(x).alias(f"{c}:std"),
            F.min(x).alias(f"{c}:min"),
            F.max(x).alias(f"{c}:max"),
        ]
    wide = df.agg(*aggs)
    for c in cols:
        wide = wide.withColumns({f"{c}:{n}": F.lit(q).cast("double") for n, q in zip(("p25", "p50", "p75"), quartiles[c])})
    return _per_column(wide, {c: ["count", "mean", "std", "min", "p25", "p50", "p75", "max"] for c in cols})


def numeric_extras(df: DataFrame, cols: list[str]) -> DataFrame:
    """Range, distinct values, zeros and their share of all rows.

    Distinct values are counted from (column, value) pairs that collapse before
    the shuffle, instead of expanding every row once per column.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [(F.max(x) - F.min(x)).alias(f"{c}:range"), F.coalesce(F.sum((x == 0).cast("long")), F.lit(0)).alias(f"{c}:zeros")]
    wide = df.agg(*aggs).withColumns({f"{c}:zero_pct": F.col(f"{c}:zeros") * 100.0 / F.col("n") for c in cols})
    base = _per_column(wide, {c: ["range", "zeros", "zero_pct"] for c in cols})
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    distinct = values.where(F.col("value").isNotNull()).groupBy("column", "value").count().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return base.join(distinct, "column", "left").fillna(0, ["distinct_values"])


def top_categories(df: DataFrame, cols: list[str], top: int = 20) -> DataFrame:
    """The most frequent values of each column with their share of all rows, nulls not counted."""
    n = df.count()
    values = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = values.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc())
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.withColumn("pct", F.col("n") * 100.0 / F.lit(n))


def date_table(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs: list[Column] = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}:count"),
            F.date_format(F.min(c), "yyyy-MM-dd").alias(f"{c}:first"),
            F.date_format(F.max(c), "yyyy-MM-dd").alias(f"{c}:last"),
            F.datediff(F.max(c), F.min(c)).cast("long").alias(f"{c}:span_days"),
        ]
    return _per_column(df.agg(*aggs), {c: ["count", "first", "last", "span_days"] for c in cols})


def decade_table(df: DataFrame, year: str, top: int = 10) -> DataFrame:
    """Companies per founding decade, share of those with a founding year."""
    known = df.where(F.col(year).isNotNull())
    counts = known.groupBy(decade(F.col(year)).alias("decade")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per decade
    share = counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(everything))
    return share.orderBy(F.col("n").desc(), F.col("decade").asc()).limit(top)


def postal_region(postal: Column) -> Column:
    code = F.trim(postal).try_cast("int")
    out = F.when(postal.isNull(), None).when(code.isNull(), REGION_INVALID)
    for digit, name in POSTAL_REGIONS.items():
        out = out.when((code >= digit * 1000) & (code < (digit + 1) * 1000), name)
    return out.otherwise(REGION_OTHER)


def region_table(df: DataFrame, postal: str) -> DataFrame:
    known = df.where(F.col(postal).isNotNull())
    counts = known.groupBy(postal_region(F.col(postal)).alias("region")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per region
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(everything))


def postal_numbers(df: DataFrame, postal: str) -> DataFrame:
    """How many postal codes are numbers, and their range."""
    code = F.trim(F.col(postal)).try_cast("double")
    return df.agg(
        F.count(code).alias("numeric_codes"),
        (F.count(code) * 100.0 / F.count(F.lit(1))).alias("numeric_pct"),
        F.min(code).alias("lowest"),
        F.max(code).alias("highest"),
        F.countDistinct(postal).alias("distinct_codes"),
    )


def industry_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("industry_text")]
