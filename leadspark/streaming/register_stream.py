"""The monthly register counts as a streaming aggregation.

The refresh job rebuilds the whole history; this does the same counts
incrementally. State is one counter per month, canton and event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.functions.dates import iso_date
from leadspark.operators.lookup import BROADCAST_ROWS
from leadspark.operators.register import counts_by_canton
from leadspark.session import scratch_path
from leadspark.sources.tables import read_table


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications as files arrive, with the canton from the static dimension tables."""
    schema = read_table(spark, sf_dir, "orders").schema
    orders = spark.readStream.schema(schema).option("pathGlobFilter", "orders*.parquet").parquet(sf_dir)
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cantons = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    if cantons.count() <= BROADCAST_ROWS:  # then no customer's orders meet in one task
        cantons = F.broadcast(cantons)
    return (
        orders.where(F.col("o_orderstatus").isin("O", "F"))
        .join(cantons, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderdate").alias("publication_date"),
            F.col("n_name").alias("kanton"),
            F.when(F.col("o_orderstatus") == "O", "HR01").otherwise("HR03").alias("shab_id"),
        )
    )


def counts_once(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Process everything available and return the counts.

    Each micro-batch replaces one version folder of the output, so a batch that
    runs again after a failure writes the same result.
    """
    path = scratch_path(spark, "register-stream")
    counts = counts_by_canton(events)

    def publish(batch: DataFrame, version: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/counts/version={version}")

    q = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    shape = "month string, kanton string, hr string, count long"
    if q.lastProgress is None or not any(p["numInputRows"] for p in q.recentProgress):
        return spark.createDataFrame([], shape)  # nothing has arrived
    versions = spark.read.parquet(f"{path}/counts")
    newest = versions.agg(F.max("version")).first()[0]
    out = versions.where(F.col("version") == newest).drop("version")
    return out.select(iso_date(F.col("month")).alias("month"), "kanton", F.col("shab_id").alias("hr"), "count")
