"""Writers: ranked leads, reports, cubes, tables and model folders."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for small aggregates only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_ranked_leads(ranked: DataFrame, path: str) -> None:
    """Leads as CSV, best first across the files in name order."""
    write_csv(ranked.orderBy("rank"), path)


def write_category_report(top: DataFrame, path: str) -> None:
    top.write.mode("overwrite").partitionBy("column").parquet(path)


def read_category_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("column", "value", "n", "rank", "pct")


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows of a database table, keeping its definition."""
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, truncate="true", **options).save()


def write_json_records(df: DataFrame, path: str) -> None:
    """One JSON record per line, nulls written out as the dashboard expects them."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_register(cube: DataFrame, dimensions: DataFrame, status: DataFrame, path: str) -> None:
    """Cube, dimension lists and status of the register refresh."""
    write_json_records(cube, f"{path}/shab_monthly")
    write_json_records(dimensions.coalesce(1), f"{path}/dimensions")
    stamped = status.withColumn("data_updated_at", F.lit(datetime.now(timezone.utc).isoformat())).withColumn(
        "data_files", F.array(F.lit("shab_monthly"), F.lit("dimensions"))
    )
    write_json_records(stamped.coalesce(1), f"{path}/status")


def write_report(report: DataFrame, path: str) -> None:
    """One nested row as one JSON document."""
    report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_model(model, path: str, params: dict, best_score: float | None = None, n_iter: int | None = None, **extra) -> None:
    """Model folder with parameters and metadata beside it."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    meta = {
        "spark_version": spark.version,
        "best_score": best_score,
        "timestamp": datetime.now(timezone.utc).isoformat(),
        "n_iter": n_iter,
        "params": params,
        **extra,
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(path: str, loader, strict: bool = False):
    """(model, params, metadata), or three Nones without a saved model.

    A model of another Spark version is returned with ``version_matches`` false,
    or refused with ``strict``.
    """
    spark = SparkSession.active()
    if not model_exists(path):
        return None, None, None
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    meta["version_matches"] = meta["spark_version"] == spark.version
    if strict and not meta["version_matches"]:
        raise RuntimeError(f"model was saved by Spark {meta['spark_version']}, this is {spark.version}")
    return loader.load(f"{path}/model"), meta["params"], meta


def model_exists(path: str) -> bool:
    """Both the model and its metadata are there, on whatever file system the path names."""
    spark = SparkSession.active()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for part in ("model", "meta"):
        p = hadoop(f"{path}/{part}")
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return False
    return True
