"""Calendar functions on timestamps without time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_literal(moment: datetime) -> Column:
    """TIMESTAMP_NTZ literal, the type the Parquet timestamps have."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def literal_like(df: DataFrame, col: str, value) -> Column:
    """Date or timestamp literal of the column's own type, whatever the time zones of session and driver."""
    return F.lit(str(value)).cast(df.schema[col].dataType)


def add_months(ts: Column, months: int) -> Column:
    """Shift by whole months, clamped to month end, keeping the time of day."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(months))


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_number(ts: Column) -> Column:
    """Months since year 0, for month differences and buckets."""
    return F.year(ts) * 12 + F.month(ts) - 1
