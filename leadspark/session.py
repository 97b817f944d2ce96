"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "leadspark") -> SparkSession:
    """Session for one machine. On a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is set only where the setting is missing and the
    session runs on one machine; on a cluster its absence is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="leadspark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/leadspark/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet below the shared folder and read it back; later passes read only the columns they use."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write the frame to the shared checkpoint folder and go on from there.

    ``spread`` deals a frame with fewer partitions than cores out to all cores,
    for work that is heavy per row; a frame that already has more is left alone.
    """
    spark = df.sparkSession
    shared_dir(spark)
    fixed = df.checkpoint(eager=True)
    cores = spark.sparkContext.defaultParallelism
    if spread and fixed.rdd.getNumPartitions() < cores:
        fixed = fixed.repartition(cores).checkpoint(eager=True)
    return fixed
