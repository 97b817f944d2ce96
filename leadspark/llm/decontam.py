"""Benchmark decontamination: an FM-index per training shard, searched backwards for every test phrase.

A phrase is each window of 10 words of a benchmark item, or a whole item of
fewer words. A shard is a slice of a partition's documents. Its words become
symbols of the benchmark's vocabulary; all other words only separate runs, and
runs too short for any phrase are left out, which loses no occurrence. Hits are
located by sampled suffix positions and merged into removal spans.

The benchmark is the stated query set. It is dealt into blocks by the hash of
the item, as many as its size asks for; one block at a time goes through the
driver, and each document meets every block inside its own task, so documents
are never shuffled.

Edge cases: a null text has no words and no hits; items with a null id or
without words are no phrases; items with equal ids count once; repeated
document rows each give a row; an empty table, of documents or of items, gives
no rows or no hits; other columns are ignored (``remove`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.llm.fmindex import FMIndex

WINDOW = 10
BLOCK_BYTES = 16 << 20
_LUT = ts.alnum_lut()


@dataclass
class Phrases:
    """One block of the benchmark: word hashes, phrases as rows of symbols, and the items of each phrase."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    item_of: np.ndarray
    phrase_of: np.ndarray
    items: list[str]

    @classmethod
    def build(cls, ids: list[str], texts: list[str], window: int = WINDOW) -> Phrases:
        rows, owner = [np.empty((0, window), np.int64)], [np.empty(0, np.int64)]
        vocabulary = np.empty(0, np.uint64)
        pieces = list(ts.slices(pa.array(texts, pa.string())))
        scans = [ts.words(p, _LUT) for p in pieces]
        if scans:
            vocabulary = np.unique(np.concatenate([w.hash for w in scans]))
        for p, w in zip(pieces, scans):
            sym = np.searchsorted(vocabulary, w.hash) + 1
            n = np.bincount(w.doc, minlength=p.hi - p.lo)
            begin = np.cumsum(n) - n
            at = np.flatnonzero((np.arange(len(sym)) - begin[w.doc] <= n[w.doc] - window) | ((n[w.doc] < window) & (np.arange(len(sym)) == begin[w.doc])))
            spot = at[:, None] + np.arange(window)
            own = np.arange(window) < np.minimum(n[w.doc[at]], window)[:, None]
            rows.append(np.where(own, sym[np.minimum(spot, len(sym) - 1)], 0) if len(sym) else rows[0])
            owner.append(w.doc[at] + p.lo)
        table, item = np.concatenate(rows), np.concatenate(owner)
        table, phrase = np.unique(table, axis=0, return_inverse=True)
        return cls(vocabulary, table, (table > 0).sum(1), item, phrase.reshape(-1), [str(i) for i in ids])

    def find(self, w: ts.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and phrase of every occurrence in a shard."""
        none = (np.empty(0, np.int64),) * 3
        if not len(self.symbols) or not len(w.hash):
            return none
        spot = np.minimum(np.searchsorted(self.vocabulary, w.hash), len(self.vocabulary) - 1)
        known = self.vocabulary[spot] == w.hash
        bounds = np.concatenate([np.flatnonzero(np.diff(w.doc)) + 1, [len(w.doc)]])
        start, end = ts.edges(known, np.concatenate([[0], bounds]))
        long = end - start >= self.lengths.min()
        start, end = start[long], end[long]
        if not len(start):
            return none
        size = end - start
        out = np.cumsum(size + 1) - size - 1  # a separator follows each run
        seq = np.zeros(int((size + 1).sum()), np.int64)
        word = np.repeat(start - out, size) + (inside := np.repeat(out, size) + _ramp(size))
        seq[inside] = spot[word] + 1
        at_word = np.full(len(seq), -1, np.int64)
        at_word[inside] = word
        index = FMIndex(seq, len(self.vocabulary) + 1)
        lo, hi = index.search(self.symbols)
        hits = np.flatnonzero(hi > lo)
        many = (hi - lo)[hits]
        phrase = np.repeat(hits, many)
        return at_word[index.locate(np.repeat(lo[hits], many) + _ramp(many))], self.lengths[phrase], phrase

    def pairs(self, doc: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """Distinct (document, item) of the given (document, phrase)."""
        order = np.argsort(self.phrase_of, kind="stable")
        ends = np.searchsorted(self.phrase_of[order], np.arange(len(self.symbols) + 1))
        keys = np.unique(np.stack([doc, phrase], 1), axis=0)
        many = ends[keys[:, 1] + 1] - ends[keys[:, 1]]
        item = self.item_of[order[np.repeat(ends[keys[:, 1]], many) + _ramp(many)]]
        return np.unique(np.stack([np.repeat(keys[:, 0], many), item], 1), axis=0)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def load(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[Broadcast[Phrases]]:
    """The benchmark's blocks as broadcasts; the driver holds one block at a time."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    out = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        out.append(sc.broadcast(Phrases.build([r["id"] for r in rows], [r["t"] for r in rows], window)))
    return out


def hits(piece: ts.Slice, blocks: list[Phrases]) -> tuple[ts.Words, np.ndarray, list[list[str]]]:
    """Words of a slice, which of them are inside an occurrence, and the items found in each text."""
    w = ts.words(piece, _LUT)
    edge = np.zeros(len(w.hash) + 1, np.int64)
    found: list[set[str]] = [set() for _ in range(piece.hi - piece.lo)]
    for block in blocks:
        first, size, phrase = block.find(w)
        if len(first):
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size, -1)
            for d, i in block.pairs(w.doc[first], phrase):
                found[d].add(block.items[i])
    return w, np.cumsum(edge[:-1]) > 0, [sorted(x) for x in found]


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, hit words, items with occurrences, and whether there are any."""
    shared = load(benchmark, window)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b.value for b in shared]
        for batch in batches:
            for piece in ts.slices(batch.column("text")):
                n = piece.hi - piece.lo
                w, hit, items = hits(piece, blocks)
                n_hit = np.bincount(w.doc[hit], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.lo, n),
                        pa.array(np.bincount(w.doc, minlength=n)),
                        pa.array(n_hit),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                        pa.array(n_hit > 0),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
                )

    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(scan, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>")


def cleaned(texts: list[str | None], blocks: list[Phrases]) -> list[str | None]:
    """Texts without their hit spans. What closes up over a gap is searched again until nothing is found."""
    out = list(texts)
    todo = [i for i, t in enumerate(out) if t]
    while todo:
        again = []
        for piece in ts.slices(pa.array([out[i] for i in todo], pa.string())):
            w, hit, _ = hits(piece, blocks)
            if not hit.any():
                continue
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(w.doc)) + 1, [len(w.doc)]])
            first, last = ts.edges(hit, bounds)
            raw = piece.buf.tobytes()
            for d in np.unique(w.doc[first]):
                own = w.doc[first] == d
                at, parts = int(piece.off[d]), []
                for a, b in zip(w.start[first[own]], w.end[last[own] - 1]):
                    parts.append(raw[at:a])
                    at = int(b)
                parts.append(raw[at : piece.off[d + 1]])
                i = todo[piece.lo + d]
                out[i] = b"".join(parts).decode()
                again.append(i)
        todo = again
    return out


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with all columns, hit spans cut out of ``text``; documents of which no word is left go.

    ``n_chars``, if there is such a column, follows the shorter text.
    """
    shared = load(benchmark, window)
    at = docs.columns.index("text")
    count = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b.value for b in shared]
        for whole in batches:
            for piece in ts.slices(whole.column(at)):
                batch = whole.slice(piece.lo, piece.hi - piece.lo)
                old = batch.column(at).to_pylist()
                new = cleaned(old, blocks)
                moved = [a != b for a, b in zip(old, new)]
                if not any(moved):
                    yield batch
                    continue
                cols = list(batch.columns)
                cols[at] = pa.array(new, batch.schema.field(at).type)
                if count is not None:
                    was = cols[count].to_pylist()
                    cols[count] = pa.array([len(t) if m else c for t, m, c in zip(new, moved, was)], batch.schema.field(count).type)
                left = [not m or bool(len(ts.words(next(ts.slices(pa.array([t], pa.string()))), _LUT).hash)) for t, m in zip(new, moved)]
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema).filter(pa.array(left))

    return docs.mapInArrow(cut, docs.schema)
