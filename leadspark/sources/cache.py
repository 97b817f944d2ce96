"""Frozen panels: Parquet by snapshot with one metadata row beside it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_cache(panel: DataFrame, path: str, horizon_months: int, source: str) -> None:
    """Write the panel, split by snapshot so later reads prune, and its metadata."""
    day = F.date_format("snapshot_date", "yyyy-MM-dd")
    panel.withColumn("snapshot_day", day).write.mode("overwrite").partitionBy("snapshot_day").parquet(f"{path}/panel")
    meta = [(horizon_months, source, datetime.now(timezone.utc).isoformat())]
    panel.sparkSession.createDataFrame(meta, "horizon_months int, source string, exported_at string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")


def read_cache(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The cached panel and its metadata; a missing cache is an error."""
    try:
        meta = spark.read.parquet(f"{path}/meta").first().asDict()
        return spark.read.parquet(f"{path}/panel").drop("snapshot_day"), meta
    except AnalysisException as missing:
        raise FileNotFoundError(f"no cached panel at {path}; export it first") from missing
