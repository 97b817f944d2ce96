"""Daily counts of register events kept up to date from a stream, by event time.

Counts of a window are final, and written, once the watermark has passed its
end; events that come later than the watermark allows are left out. State is
one counter per open window and type, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.session import scratch_path
from leadspark.sources.tables import read_table

WINDOW, DELAY = "1 day", "2 hours"
_ROW = "window_start timestamp, event_type string, count long"


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", files_per_batch: int | None = None) -> DataFrame:
    """The events of a table (a file or a folder of files) as its files arrive."""
    reader = spark.readStream.schema(read_table(spark, sf_dir, table).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/{table}.parquet*")  # by a pattern, as the source takes a plain path for a folder


def window_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """window_start, event_type, count; the same roll-up on a stream and on a table, where the watermark does nothing.

    Events without a time belong to no window; a null type is a type of its own.
    """
    timed = events.select(F.col(time).cast("timestamp").alias("ts"), F.col(kind).alias("event_type")).where(F.col("ts").isNotNull())
    counts = timed.withWatermark("ts", delay).groupBy(F.window("ts", window), "event_type").count()
    return counts.select(F.col("window.start").alias("window_start"), "event_type", "count")


def closed_windows(spark: SparkSession, counts: DataFrame, path: str | None = None) -> DataFrame:
    """Process all that has arrived and return the windows closed so far, those of earlier calls on the same ``path`` included.

    Append mode: each window is written once, by the batch in which the
    watermark passes its end, and the file sink's log leaves out what a failed
    batch wrote. A later call goes on from the stored offsets, watermark and state.
    """
    path = path or scratch_path(spark, "event-windows")
    query = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{path}/windows")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(_ROW).parquet(f"{path}/windows")
