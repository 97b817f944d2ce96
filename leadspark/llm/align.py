"""Cross-tokenizer alignment by interval coalescing.

Each text is encoded by two vocabularies. Their tokens are intervals of the
same bytes: all of them are sorted by start, a running maximum of their ends is
kept, and a group breaks wherever a start reaches it. Within a group, overlaps
are expanded to pairs of tokens; those pairs whose intervals end together are
the links. How often an id pair is linked is counted over the whole corpus, and
each document is then held against these counts.

Texts are read and encoded once; the scan stores each document's distinct id
pairs, and counting and scoring work on those. Counts go to the tasks in
broadcast blocks of bounded size; where they would take more than a few blocks,
a salted join takes their place.

Edge cases: a null or empty text, and one whose tokens do not spell the text
(normalised white space or the mark U+2581 inside), has no tokens: zeros and an
empty groups_sha256. Strings of special tokens are plain text. Rows are taken
one by one, so repeated rows and null ids each give a row of their own, and
repeated rows count as often as they stand there. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadspark.llm import textscan as ts
from leadspark.llm import tokens
from leadspark.session import scratch_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: An id pair is one number: A's id above this many bits of B's.
ID_BITS = 20
#: Id pairs in one broadcast block (about 60 MB), and the most blocks before a salted join takes over.
BLOCK_PAIRS, MAX_BLOCKS = 1 << 20, 8
SALTS = 16


class Spelling(NamedTuple):
    """Bytes of all tokens of a vocabulary, one after the other, and where each begins."""

    flat: np.ndarray
    off: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Spelling:
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int64))

    def size(self, ids: np.ndarray) -> np.ndarray:
        return self.off[ids + 1] - self.off[ids]

    def write(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids spell."""
        size = self.size(ids)
        return self.flat[np.repeat(self.off[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


class Side:
    """One vocabulary: how it encodes the texts of a slice, and how its tokens are spelled."""

    spelling: Spelling

    def encode(self, piece: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError


class ByteSide(Side):
    """A byte-level vocabulary of the tokenizers library; the texts bring their leading space."""

    def __init__(self, path: str):
        self.encoder = tokens.Encoder(path, spaced=True)
        self.encoder.tokenizer.encode_special_tokens = True
        byte = {c: b for b, c in self.encoder.letters.items()}
        names = sorted(self.encoder.tokenizer.get_vocab().items(), key=lambda e: e[1])
        entries = [b""] * (names[-1][1] + 1)
        for name, i in names:
            entries[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.spelling = Spelling.of(entries)

    def encode(self, piece: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
        ids, count = self.encoder.encode(piece)
        return ids.astype(np.int64), count


class PieceSide(Side):
    """A sentencepiece vocabulary, which puts the leading space there itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        piece = self.model.id_to_piece
        self.spelling = Spelling.of([bytes([int(piece(i)[3:-1], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode() for i in ids])

    def encode(self, piece: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
        raw, off = piece.buf.tobytes(), piece.off
        own = self.model.encode([raw[a + 1 : b].decode() for a, b in zip(off[:-1], off[1:])], num_threads=1)
        return np.array([i for ids in own for i in ids], np.int64), np.array([len(ids) for ids in own], np.int64)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both vocabularies, kept by a worker over its tasks."""
    return ByteSide(path_a), PieceSide(path_b)


def coalesce(starts: np.ndarray, ends: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Group of each interval: sorted by start, a group breaks where a start reaches the running maximum of the ends."""
    order = np.lexsort((second, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of A and B tokens that share a byte, as positions; a token overlaps a stretch of the other side's."""
    first = np.searchsorted(end_b, start_a, "right")
    n = np.maximum(np.searchsorted(start_b, end_a, "left") - first, 0)
    a = np.repeat(np.arange(len(start_a)), n)
    return a, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[a]


def linked(end_a: np.ndarray, end_b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs whose intervals end together."""
    a, b = pairs
    same = end_a[a] == end_b[b]
    return a[same], b[same]


def _matching(piece: ts.Slice, side: Side, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which texts of the slice their tokens spell."""
    total = np.concatenate([[0], np.cumsum(side.spelling.size(ids))])
    ends = np.concatenate([[0], np.cumsum(count)])
    size = total[ends[1:]] - total[ends[:-1]]
    ok = size == np.diff(piece.off)
    if not ok.all():  # only texts of the right length can be compared byte by byte
        doc = np.repeat(np.arange(len(count)), count)
        ids = ids[ok[doc]]
    inside = np.repeat(ok, np.diff(piece.off))
    same = side.spelling.write(ids) == piece.buf[inside]
    off = np.concatenate([[0], np.cumsum(np.where(ok, np.diff(piece.off), 0))])
    return ok & (ts.per_doc(~same, off) == 0)


@lru_cache(maxsize=1)
def _decimals(n: int) -> np.ndarray:
    """Each id's decimal, followed by one of the separators: by separator, then id."""
    return np.array([f"{i}{sep}" for sep in ",|;" for i in range(n)], object).reshape(3, n)


def groups_text(ids: np.ndarray, second: np.ndarray, group: np.ndarray) -> list[str]:
    """Each token's id with the separator after it, in order of group, side and place: ``a1,a2|b1;a3|b2,``"""
    order = np.lexsort((second, group))
    side, own = second[order], group[order]
    after = np.full(len(order), 2, np.int64)
    after[:-1] = np.where(own[1:] != own[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
    table = _decimals(1 << max(int(ids.max()).bit_length(), 16))
    return table[after, ids[order]].tolist()


class Aligned(NamedTuple):
    """Per text of a slice: counts and digest; and its distinct id pairs with how often they are linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def align(piece: ts.Slice, a: Side, b: Side) -> Aligned:
    """Aligns the texts of a slice, each with its leading space."""
    n = piece.hi - piece.lo
    given = [side.encode(piece) for side in (a, b)]
    ok = (np.diff(piece.off) > 1) & _matching(piece, a, *given[0]) & _matching(piece, b, *given[1])
    ids, docs, starts, ends, count = [], [], [], [], []
    for side, (own, k) in zip((a, b), given):
        doc = np.repeat(np.arange(n), k)
        own, doc = own[ok[doc]], doc[ok[doc]]
        end = np.cumsum(side.spelling.size(own))  # both sides spell the same texts, so one line of bytes holds them all
        ids.append(own), docs.append(doc), ends.append(end), starts.append(end - side.spelling.size(own)), count.append(np.where(ok, k, 0))
    digest, n_groups = [""] * n, np.zeros(n, np.int64)
    if not ok.any():
        none = np.empty(0, np.int64)
        return Aligned(count[0], count[1], n_groups, n_groups.copy(), digest, none, none, none)
    second = np.repeat([0, 1], [len(ids[0]), len(ids[1])])
    group = coalesce(np.concatenate(starts), np.concatenate(ends), second)
    owner = np.zeros(int(group.max()) + 1, np.int64)
    owner[group] = np.concatenate(docs)
    n_groups = np.bincount(owner, minlength=n)
    parts = groups_text(np.concatenate(ids), second, group)
    stop = np.cumsum(count[0] + count[1])
    for d in np.flatnonzero(ok):
        digest[d] = hashlib.sha256("".join(parts[stop[d] - count[0][d] - count[1][d] : stop[d]])[:-1].encode()).hexdigest()
    i, j = linked(ends[0], ends[1], overlaps(starts[0], ends[0], starts[1], ends[1]))
    n_links = np.bincount(docs[0][i], minlength=n)
    keys, times = np.unique(docs[0][i] << 2 * ID_BITS | ids[0][i] << ID_BITS | ids[1][j], return_counts=True)
    return Aligned(count[0], count[1], n_groups, n_links, digest, keys >> 2 * ID_BITS, keys & ((1 << 2 * ID_BITS) - 1), times)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def scan(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: a row number, doc_id, counts, groups_sha256, and the distinct id pairs with how often each is linked; stored."""
    src = docs.select("doc_id", F.concat(F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for piece in ts.slices(batch.column("text")):
                n = piece.hi - piece.lo
                out = align(piece, a, b)
                off = np.searchsorted(out.doc, np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (out.pair, out.times.astype(np.int32))]
                own = [pa.array(np.arange(row, row + n)), batch.column("doc_id").slice(piece.lo, n), *(pa.array(getattr(out, c).astype(np.int64)) for c in _COUNTS), pa.array(out.digest)]
                row += n
                yield pa.RecordBatch.from_arrays(own + lists, names=["row", "doc_id", *_COUNTS, "groups_sha256", "pair", "times"])

    path = scratch_path(docs.sparkSession, "aligned")
    shape = f"row long, doc_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, pair array<long>, times array<int>"
    src.mapInArrow(run, shape).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def links(scanned: DataFrame) -> DataFrame:
    """One row for each distinct id pair of a document: row, pair, times."""
    return scanned.select("row", F.explode(F.arrays_zip("pair", "times")).alias("l")).select("row", "l.pair", "l.times")


def pair_counts(scanned: DataFrame) -> DataFrame:
    """pair, n: how many links of the corpus hold it; best: no pair of the same B id has more. Stored."""
    spark = scanned.sparkSession
    counts = links(scanned).groupBy("pair").agg(F.sum("times").alias("n"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)))  # at most as many rows as A has ids
    path = scratch_path(spark, "pairs")
    counts.withColumn("best", F.col("n") == F.max("n").over(same_b)).write.parquet(path)
    return spark.read.parquet(path)


def scored(scanned: DataFrame, counts: DataFrame, block_pairs: int = BLOCK_PAIRS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """row, n_best, count_sum of each document with links."""
    own = links(scanned)
    blocks = -(-counts.count() // block_pairs)
    if blocks <= max_blocks:
        # each block holds about block_pairs rows by hash
        block = F.pmod(F.xxhash64("pair"), F.lit(max(blocks, 1)))
        joined = [own.join(F.broadcast(counts.filter(block == i)), "pair") for i in range(max(blocks, 1))]
    else:
        salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS)))).alias("salt")
        joined = [own.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(counts.select("*", salts), ["pair", "salt"])]
    sums = [j.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")) for j in joined]
    out = sums[0]
    for more in sums[1:]:
        out = out.unionByName(more)
    return out.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")) if len(sums) > 1 else out


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, **bounds: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scanned = scan(docs, path_a or tokens.vocabulary(VOCABULARY_A), path_b or tokens.vocabulary(VOCABULARY_B))
    sums = scored(scanned, pair_counts(scanned), **bounds)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return scanned.drop("pair", "times").join(sums, "row", "left").select("doc_id", *_COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256")
