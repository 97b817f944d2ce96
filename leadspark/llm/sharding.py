"""Shards by longest-processing-time scheduling: groups that must stay together go, largest first, to the least-loaded shard.

Equal texts are a group. Groups of at least 1 / (shards * UNITS) of all bytes,
of which there can be at most shards * UNITS, are scheduled one by one; smaller
ones are joined by the hash of their text into as many chunks, which are
scheduled like groups. So the heap never sees more than 2 * shards * UNITS
items, however many documents there are, and loads differ by about one chunk.

The law is ``bytes``: sizes are as near equal as whole groups allow (a group
larger than a shard's fair share fills a shard alone).

Edge cases: a null text has no bytes and null texts are one group; repeated
rows are equal texts and each gets a slot; doc_id may be null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadspark.session import scratch_path

SHARDS = 40
#: Chunks per shard; bounds the driver's table at 2 * shards * UNITS rows.
UNITS = 512
ROW_BYTES = 16
SLOT_ROWS = 5_000
MIN_SLICES = 16


def schedule(sizes: dict, shards: int) -> dict:
    """Longest processing time first; ties by key, then by shard number."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for key, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, k = heapq.heappop(heap)
        out[key] = k
        heapq.heappush(heap, (load + size, k))
    return out


def deal(docs: DataFrame, shards: int = SHARDS, units: int = UNITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for each row of ``docs``."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    chunks = shards * units
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("null")).alias("text_group"),
    ).withColumn("chunk", F.pmod(F.xxhash64("text_group"), F.lit(chunks)))
    path = scratch_path(spark, "sizes")  # texts are read once; later steps read this narrow table
    rows.write.parquet(path)
    rows = spark.read.parquet(path)

    groups = rows.groupBy("text_group", "chunk").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    least = -(-total // chunks)
    is_large = F.col("size") >= least
    unit = F.when(is_large, F.col("text_group")).otherwise(F.format_string("%d", "chunk"))
    loads = groups.groupBy(unit.alias("unit"), is_large.alias("large")).agg(F.sum("size").alias("size"))
    sizes = {(r["large"], r["unit"]): r["size"] for r in loads.collect()}  # at most 2 * chunks rows
    placed = schedule(sizes, shards)

    large = spark.createDataFrame([(u, k) for (big, u), k in placed.items() if big], "text_group string, own_shard int")
    small = spark.createDataFrame([(int(u), k) for (big, u), k in placed.items() if not big], "chunk long, chunk_shard int")
    dealt = (
        rows.join(F.broadcast(large), "text_group", "left")
        .join(F.broadcast(small), "chunk", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "chunk_shard").alias("shard"))
    )
    return _slots(dealt, shards, n).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _slots(dealt: DataFrame, shards: int, n: int) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps.

    A shard is cut into slices by hash, so that one shard may hold most rows:
    a slot is the number of rows in the slices before plus the place in the
    slice.
    """
    slices = max(MIN_SLICES, -(-n // (shards * SLOT_ROWS)))
    cut = dealt.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slices)))
    upto = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("shard", "slice").agg(F.count("*").alias("n")).select("shard", "slice", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size"))
    return cut.withColumn("place", place).join(before, ["shard", "slice"]).withColumn("slot", F.col("before") + F.col("place") - 1)
