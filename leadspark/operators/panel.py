"""Leakage-safe company by snapshot panel with a forward-looking label.

One definition serves training, counting and scoring, so they cannot drift.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.functions import features as X
from leadspark.functions.dates import add_months, ts_literal
from leadspark.schema import NOT_DELETED


@dataclass(frozen=True)
class PanelSpec:
    """``as_of`` is the reference day; offsets are months back from it."""

    as_of: datetime
    offsets: tuple[int, ...] = (36, 30, 24, 18, 12)
    horizon_months: int = 12


def label_window_complete(snapshot: Column, spec: PanelSpec) -> Column:
    """The outcome window of the snapshot has ended by ``as_of``."""
    return snapshot <= add_months(ts_literal(spec.as_of), -spec.horizon_months)


def at_risk(joined: Column, snapshot: Column, strict: bool = False) -> Column:
    """Not a member at the snapshot. Scoring uses the strict form."""
    return joined.isNull() | ((joined > snapshot) if strict else (joined >= snapshot))


def exists_at(founded: Column, snapshot: Column) -> Column:
    return founded.isNull() | (founded <= F.year(snapshot))


def alive_at(deleted: Column, snapshot: Column) -> Column:
    """Not deleted by the snapshot; the sentinel date means never."""
    return deleted.isNull() | (deleted == F.lit(NOT_DELETED).cast("date")) | (deleted > snapshot)


def label(joined: Column, snapshot: Column, horizon_months: int) -> Column:
    """1 where the company joins in [snapshot, snapshot + horizon)."""
    hit = joined.isNotNull() & (joined >= snapshot) & (joined < add_months(snapshot, horizon_months))
    return F.when(hit, 1).otherwise(0)


def with_snapshots(companies: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every company at every snapshot. The few dates are a literal array: no join, no shuffle."""
    dates = F.array(*[add_months(ts_literal(spec.as_of), -n) for n in spec.offsets])
    return companies.withColumn("snapshot_date", F.explode(dates))


def modeling_panel(companies: DataFrame, spec: PanelSpec, check_alive: bool = True) -> DataFrame:
    """At-risk companies per complete snapshot with their label."""
    s = F.col("snapshot_date")
    keep = (
        label_window_complete(s, spec) & at_risk(F.col("joined_at"), s) & exists_at(F.col("founding_year"), s)
    )
    if check_alive:
        keep = keep & alive_at(F.col("deleted_at"), s)
    out = with_snapshots(companies, spec).where(keep).withColumn("target", label(F.col("joined_at"), s, spec.horizon_months))
    return with_row_key(out)


def current_prospects(companies: DataFrame, spec: PanelSpec) -> DataFrame:
    """Non-members on ``as_of``, for scoring."""
    s = F.col("snapshot_date")
    keep = at_risk(F.col("joined_at"), s, strict=True) & exists_at(F.col("founding_year"), s) & alive_at(F.col("deleted_at"), s)
    return with_row_key(companies.withColumn("snapshot_date", ts_literal(spec.as_of)).where(keep))


def with_row_key(df: DataFrame) -> DataFrame:
    """One long key per company and snapshot month."""
    s = F.col("snapshot_date")
    return df.withColumn("row_key", F.col("company_id") * 1000000 + F.year(s) * 100 + F.month(s))


def add_temporal_features(df: DataFrame) -> DataFrame:
    """Company age and season at the snapshot; neutral values where a source column is absent."""
    have = set(df.columns)
    cols: dict[str, Column] = {}
    if {"founding_year", "snapshot_date"} <= have:
        age = X.company_age(F.col("founding_year"), F.col("snapshot_date"))
        cols["company_age_years"] = age
        cols["company_age_log"] = F.log1p(age)
        cols["company_age_bucket"] = X.age_bucket(age)
    else:
        cols["company_age_years"] = F.lit(0)
        cols["company_age_log"] = F.lit(0.0)
        cols["company_age_bucket"] = F.lit(X.AGE_UNKNOWN)
    if "snapshot_date" in have:
        s = F.col("snapshot_date")
        cols["month_sin"] = X.month_sin(s)
        cols["month_cos"] = X.month_cos(s)
        cols["is_quarter_end"] = X.is_quarter_end(s)
        cols["is_summer"] = X.is_summer(s)
        cols["quarter"] = F.quarter(s)
    else:
        cols["month_sin"] = F.lit(0.0)
        cols["month_cos"] = F.lit(1.0)
        cols["is_quarter_end"] = F.lit(0)
        cols["is_summer"] = F.lit(0)
        cols["quarter"] = F.lit(1)
    return df.withColumns(cols)


#: What company features are made from.
COMPANY_SOURCES = ("headcount", "revenue", "postal_code", "industry_code_06", "canton")


def add_company_features(df: DataFrame) -> DataFrame:
    """Missing flags, postal prefixes, industry hierarchy, canton by section, log transforms."""
    return df.withColumns(_company_features(set(df.columns)))


def feature_sources(df: DataFrame, features: tuple[str, ...], keep: list[str]) -> DataFrame:
    """Only ``keep`` and the columns from which :func:`add_company_features` gives ``features`` again."""
    made = _company_features(set(df.columns))
    wanted = {*keep, *COMPANY_SOURCES, *(c for c in features if c not in made)}
    return df.select(*[c for c in df.columns if c in wanted])


def _company_features(have: set[str]) -> dict[str, Column]:
    cols: dict[str, Column] = {}
    for c in ("headcount", "revenue"):
        if c in have:
            cols[f"is_missing_{c}"] = X.missing_flag(F.col(c))
            cols[f"{c}_log1p"] = X.log1p_floor(F.col(c))
    if "postal_code" in have:
        cols["plz2"] = X.postal_prefix(F.col("postal_code"), 2)
        cols["plz3"] = X.postal_prefix(F.col("postal_code"), 3)
    section: Column = F.lit(X.MISSING)
    if "industry_code_06" in have:
        section = X.industry_section(F.col("industry_code_06"))
        cols["noga_division"] = X.industry_digits(F.col("industry_code_06"), 2)
        cols["noga_group"] = X.industry_digits(F.col("industry_code_06"), 3)
    else:
        cols["noga_division"] = F.lit(X.MISSING)
        cols["noga_group"] = F.lit(X.MISSING)
    cols["noga_section"] = section
    cols["canton_noga_section"] = X.cross_feature(F.col("canton"), section) if "canton" in have else F.lit(X.MISSING)
    return cols


def feature_frame(panel: DataFrame) -> DataFrame:
    """Panel with every engineered column."""
    return add_company_features(add_temporal_features(panel))
