"""Best-fit packing with certified bin counts.

Documents become token pieces of at most the capacity; pieces are dealt into
partitions of bounded size and packed best-fit decreasing. Dual-feasible
functions give each partition a lower bound for its number of bins. Where the
bound is met the packing is proven best and stays, but for the emptiest bin;
partitions with a gap exchange the documents of all bins that are not full -
these are dealt anew into fewer, larger partitions - and best-fit decreasing
runs again. An exchange that does not save a bin is undone.

Edge cases: a null or empty text is the end id alone; only documents longer
than the capacity are cut; repeated rows are packed each; doc_id may be null;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.llm import tokens
from leadspark.session import scratch_path

CAPACITY = 2048
#: Pieces a partition packs at first; each exchange doubles it.
GROUP_ROWS = 10_000
EXCHANGES = 3
VOCABULARY = "word_bpe_49k.json"

_PIECE = "piece int, start long, length long, ids_crc32 long, salt long"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, spaced: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and a number to deal rows by) for each piece of each document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = tokens.encoder(path, spaced), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in batches:
            for part in ts.slices(batch.column("text")):
                ids, count = tokens.with_end(*enc.encode(part))
                many = -(-count // capacity)
                doc = np.repeat(np.arange(len(count)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(count[doc] - start, capacity)
                begin = (np.cumsum(count) - count)[doc] + start
                sums = [tokens.crc(ids[b : b + n]) for b, n in zip(begin, length)]
                row += len(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.lo, part.hi - part.lo).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        pa.array(np.arange(row - len(doc), row)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
                )

    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(scan, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {_PIECE}")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins.

    ``room`` has a bit for each amount of free space that some open bin has, so
    the tightest fit is its lowest bit from the item's size up.
    """
    bins, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    room, used = 0, 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = room >> size
        if fits:
            space = (fits & -fits).bit_length() - 1 + size
            b = free[space].pop()
            if not free[space]:
                room &= ~(1 << space)
        else:
            space, b = capacity, used
            used += 1
        bins[i], offset[i] = b, capacity - space
        if space > size:
            free[space - size].append(b)
            room |= 1 << (space - size)
    return bins, offset, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Largest bound of three families of dual-feasible functions, over the counts of each size.

    Each function maps sizes so that no set of items that fits a bin exceeds
    the capacity; the mapped total over the capacity then bounds the bins.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    # f_t: sizes above capacity - t fill a bin, those below t count nothing
    many, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * size)])
    t = np.arange(1, capacity // 2 + 1)
    filled = (many[-1] - many[capacity - t + 1]) * capacity
    between = total[capacity - t + 1] - total[t]
    best = max(best, int((-(-(filled + between) // capacity)).max()))
    for k in range(1, 33):
        # u_k: rounded down to multiples of capacity / k, unless (k + 1) size is a multiple of the capacity
        whole, rest = np.divmod((k + 1) * size, capacity)
        best = max(best, -(-int((count * np.where(rest == 0, size * k, whole * capacity)).sum()) // (capacity * k)))
        # phi_t: what the rest of a bin could hold of pieces of size t, taken from all it can hold
        step = capacity // (k + 1)
        if step:
            most = capacity // step
            mapped = np.where(2 * size > capacity, 2 * (most - (capacity - size) // step), np.where(2 * size == capacity, most, 2 * (size // step)))
            best = max(best, -(-int((count * mapped).sum()) // (2 * most)))
    return best


def _packer(number: int, capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packs a partition; in an exchange (``number`` > 0) the old bins stay where no bin is saved."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("salt", ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, offset, used = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        if number == 0 or used < rows["sequence_id"].nunique():
            rows["sequence_id"] = (np.int64(number) << 56) + (np.int64(rows["deal"].iloc[0]) << 28) + bins
            rows["offset"] = offset
        else:
            used = rows["sequence_id"].nunique()
        fill = rows.groupby("sequence_id")["length"].transform("sum")
        rows["certified"] = used <= bound
        # a certified partition gives only its emptiest bin away: the bounds round up once a partition
        loose = rows["sequence_id"] == rows["sequence_id"].iloc[int(fill.argmin())]
        rows["settled"] = (rows["certified"] & ~loose) | (fill >= capacity)
        return rows.drop(columns="deal")

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, exchanges: int = EXCHANGES) -> DataFrame:
    """``pieces`` with sequence_id and offset, and whether the bins of a piece's last partition are proven fewest."""
    spark = pieces.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    kind = pieces.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, {_PIECE}, sequence_id long, offset long, certified boolean, settled boolean"
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt", "sequence_id", "offset", "certified", "settled"]
    now = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "certified": F.lit(False), "settled": F.lit(False)})
    done = []
    for number in range(exchanges + 1):
        left = now.count()
        if not left:
            break
        deals = max(1, round(left / (group_rows << number)))
        # an exchange keeps the documents of a bin together, so that old and new bins can be compared
        key = F.xxhash64("salt") if number == 0 else F.xxhash64("sequence_id", F.lit(number))
        dealt = now.withColumn("deal", F.pmod(key, F.lit(deals)))
        packed = stored(dealt.groupBy("deal").applyInPandas(_packer(number, capacity), shape), "packed")
        last = number == exchanges
        done.append(packed if last else packed.filter("settled"))
        now = packed.filter("NOT settled")
    if not done:
        return now.select(*names[:5], "sequence_id", "offset", "certified")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*names[:5], "sequence_id", "offset", "certified")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified."""
    spark = docs.sparkSession
    scratch = scratch_path(spark, "pieces")
    pieces_of(docs, path or tokens.vocabulary(VOCABULARY), capacity).write.parquet(scratch)
    return pack_pieces(spark.read.parquet(scratch), capacity, group_rows)
