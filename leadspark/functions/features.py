"""Feature expressions of the lead model. All stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label of an absent category, age bucket edges and names, quarter-end and summer months.
MISSING = "missing"
AGE_EDGES = (2, 5, 10, 20)
AGE_LABELS = ("startup", "early_growth", "established", "mature", "legacy")
AGE_UNKNOWN = "unknown"
QUARTER_END_MONTHS = (3, 6, 9, 12)
SUMMER_MONTHS = (7, 8)


def company_age(founded: Column, snapshot: Column) -> Column:
    """Whole years at the snapshot; unknown founding year and later founding count as 0."""
    year = F.year(snapshot)
    return F.greatest(F.lit(0), year - F.coalesce(founded.cast("int"), year))


def log1p_floor(x: Column) -> Column:
    """log(1 + x) with nulls and negatives taken as 0."""
    return F.log1p(F.greatest(F.coalesce(x.cast("double"), F.lit(0.0)), F.lit(0.0)))


def age_bucket(age: Column) -> Column:
    """Right-closed age bands."""
    out = F.when(age <= AGE_EDGES[0], AGE_LABELS[0])
    for edge, label in zip(AGE_EDGES[1:], AGE_LABELS[1:-1]):
        out = out.when(age <= edge, label)
    return out.when(age.isNotNull(), AGE_LABELS[-1])


def month_sin(ts: Column) -> Column:
    return F.sin(F.month(ts) * F.lit(2 * math.pi / 12))


def month_cos(ts: Column) -> Column:
    return F.cos(F.month(ts) * F.lit(2 * math.pi / 12))


def is_quarter_end(ts: Column) -> Column:
    return F.month(ts).isin(*QUARTER_END_MONTHS).cast("int")


def is_summer(ts: Column) -> Column:
    return F.month(ts).isin(*SUMMER_MONTHS).cast("int")


def missing_flag(x: Column) -> Column:
    return x.isNull().cast("int")


def or_missing(x: Column) -> Column:
    """Category as text, with nulls and the text form of a null as one label."""
    text = x.cast("string")
    return F.when(text.isNull() | (text == "nan"), MISSING).otherwise(text)


def postal_prefix(postal: Column, length: int) -> Column:
    return F.coalesce(F.substring(postal.cast("string"), 1, length), F.lit(MISSING))


def industry_section(code: Column) -> Column:
    """First character of the industry code."""
    return F.coalesce(F.nullif(F.substring(F.trim(code.cast("string")), 1, 1), F.lit("")), F.lit(MISSING))


def industry_digits(code: Column, digits: int) -> Column:
    """Leading digits of the industry code: two for the division, three for the group."""
    found = F.regexp_extract(F.trim(code.cast("string")), rf"^(\d{{{digits}}})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(MISSING))


def cross_feature(canton: Column, section: Column) -> Column:
    return F.concat_ws("_", or_missing(canton), section)


def concat_key(*cols: Column) -> Column:
    """Joined text key over several columns; a null becomes ``nan``."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("nan")) for c in cols])


def grouped_value(x: Column, keep: tuple[str, ...], other: str = "OTHER") -> Column:
    """Values outside ``keep``, and nulls, become one group."""
    return F.when(x.isin(*keep), x).otherwise(F.lit(other))


def sigmoid(s: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def clip01(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def is_finite(x: Column) -> Column:
    d = x.cast("double")
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))


def decade(year: Column) -> Column:
    return (F.floor(year / F.lit(10)) * 10).cast("int")


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def yeo_johnson(x: Column, lam: Column | float) -> Column:
    """Power transform of Yeo and Johnson (2000) at a given lambda."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    eps = 1e-9
    rest = F.lit(2.0) - lam
    up = F.when(F.abs(lam) < eps, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    down = F.when(F.abs(rest) < eps, -F.log1p(-x)).otherwise(-(F.pow(F.lit(1.0) - x, rest) - 1) / rest)
    return F.when(x >= 0, up).otherwise(down)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
        F.lit(0.0),
        lambda acc, d: acc + d,
    )


def safe_sqrt(d2: Column) -> Column:
    return F.sqrt(F.greatest(d2, F.lit(0.0)))
