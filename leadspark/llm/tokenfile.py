"""Token ids in a file format of independently coded, checksummed blocks.

Documents are dealt into ranges of doc_id and sorted, tokenized, and written as
segments: rows of a Parquet table (so that Spark's commit protocol covers lost
executors) that hold the documents of the segment, their lengths, and the bytes
of :func:`leadspark.llm.rangecoder.pack`. A segment can be read alone, and so
can each block in it. Where a document starts among all ids follows from the
segments' sizes: sums per range on the driver, one number each, and a window
inside a range.

Edge cases: a null or empty text is the end id alone; rows with a null doc_id
come first; repeated rows are written each, and rows with equal doc_id in the
order of their texts' hash; an empty table writes no segment; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.llm import rangecoder, tokens
from leadspark.llm import textscan as ts

VOCABULARY = "byte_bpe_50k.json"
VOCABULARY_SIZE = 50_257
#: A segment ends after the document that reaches so many ids; a task's rest goes to its last segment.
SEGMENT_IDS = rangecoder.BLOCK * rangecoder.LANES


def write(docs: DataFrame, target: str, path: str | None = None, spaced: bool = True, vocabulary_size: int = VOCABULARY_SIZE, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of all ``docs`` to ``target`` in ascending doc_id order."""
    spark = docs.sparkSession
    path = path or tokens.vocabulary(VOCABULARY)
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = tokens.encoder(path, spaced), TaskContext.get().partitionId(), 0
        full: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        before = 0

        def segment(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            owners = pa.concat_arrays([h[0] for h in held])
            ids, count = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), one(owners), one(pa.array(count)), pa.array([rangecoder.pack(ids, vocabulary_size)], pa.binary())],
                names=["part", "segment", "before", "n_ids", "doc_ids", "lengths", "data"],
            )

        size = 0
        for batch in batches:
            for piece in ts.slices(batch.column("text")):
                ids, count = tokens.with_end(*enc.encode(piece))
                held.append((batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo), ids, count))
                size += len(ids)
                if size >= segment_ids:
                    if full:
                        yield segment(full)
                        before += sum(len(h[1]) for h in full)
                        number += 1
                    full, held, size = held, [], 0
        if full or held:
            yield segment(full + held)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(scan, f"part int, segment int, before long, n_ids long, doc_ids array<{kind}>, lengths array<long>, data binary").write.parquet(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""
    segments = spark.read.parquet(target)
    sums = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row for each range
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in sums], dtype=np.int64)]).tolist()
    parts = spark.createDataFrame([(r["part"], b) for r, b in zip(sums, starts)], "part int, before_part long")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = rangecoder.unpack(batch.column("data")[i].as_py())
                count = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(count)
                sums = [tokens.crc(ids[e - n : e]) for e, n in zip(ends, count)]
                start = ends - count + batch.column("start")[i].as_py()
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, pa.array(start), pa.array(count), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = segments.join(F.broadcast(parts), "part")  # as many rows as there are ranges
    return placed.select("doc_ids", "lengths", (F.col("before_part") + F.col("before")).alias("start"), "data").mapInArrow(scan, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
