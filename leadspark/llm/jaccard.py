"""Exact Jaccard join of documents on word shingles, filtered by prefixes under several global orders.

Two sets with similarity s or more share a token among the first
n - ceil(s n) + 1 tokens of each, under any order of all tokens that both
follow. Candidates must share one under each of several orders: the first
order's prefixes are joined by token, and for each pair that comes out the
prefixes under the other orders are intersected before the sets are compared.
All orders put tokens that many documents have last and deal the others by a
hash of their own. Only speed depends on the order, so it rests on counts that
each task takes of its own slice, summed, and on a list of bounded length.

Equal sets are one node. Links matter for connection only, so a group of m near
copies need not be compared in m (m - 1) / 2 pairs: each node is first compared
with the centre that most of its tokens name, then with all other centres that
it is not connected with and along a forest of the pairs that look similar, then
every pair that shares a token and is not connected yet is compared. No link between different components is lost.

Before sets are moved, pairs are held against sketches: for each of some bits,
whether an odd number of a set's tokens fall there. Each bit in which two
sketches differ needs a token that only one of the sets has, so pairs with too
many of them are not similar.

Tokens and nodes are 64-bit hashes; among m different sets about m^2 / 2^65
pairs of nodes would be taken for one.

Edge cases: a text with fewer words than a shingle is one shingle; without
words, or null, it is linked with nothing; repeated rows are equal sets; the
component of documents that all lack an id is null; an empty table gives no
rows; other columns are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.llm.components import components
from leadspark.session import scratch_path

SHINGLE = 5
NUM, DEN = 3, 4  # similarity of at least 3/4
ORDERS = 3
#: Seeds of the two hashes that pick each token's centres.
CENTRES = 1, 2
#: Up to so many documents with a token, those without a possible partner are dropped.
PROBED = 1_024
#: A task reports tokens that so many documents of one of its slices have.
LOCAL_DF = 2
#: Most tokens known as frequent (4 MB in each task); the others count as rare.
MAX_FREQUENT = 1 << 18
COUNT_TOKENS = 1_500_000
ROWS_PER_TASK = 1_000_000
#: No more tasks than one for each so many rows: the driver keeps a record of every task.
LEAST_ROWS = 50_000
BITMAP_BITS = 1 << 26
#: Bytes of a sketch: at least a bit for each token within these bounds. Where a row is made for each token, the lower one.
SKETCH_BYTES = 64, 4096

_LUT = ts.not_space_lut(fold_case=True)
_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 16, dtype=np.uint64)


def prefix_length(n):
    """How many of ``n`` ordered tokens a similar set must share one of."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def shingle_sets(piece: ts.Slice) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted distinct shingle hashes of each text."""
    w = ts.words(piece, _LUT)
    h, whole = ts.windows(w, SHINGLE)
    n = np.bincount(w.doc, minlength=piece.hi - piece.lo)
    ends = np.cumsum(n)
    empty = np.empty(0, np.uint64)
    for i, (k, e) in enumerate(zip(n, ends)):
        if k >= SHINGLE:
            yield i, np.unique(h[e - k : e - SHINGLE + 1])
        elif k:
            tail = w.hash[e - k : e]
            yield i, ts.mix(np.array([np.sum(tail * _SEEDS[:k], dtype=np.uint64) + np.uint64(k)]))
        else:
            yield i, empty


def node_of(tokens: np.ndarray) -> int | None:
    """One number for a set, equal for equal sets."""
    return None if not len(tokens) else int(ts.mix(np.array([np.sum(ts.mix(tokens ^ _SEEDS[0]), dtype=np.uint64) + np.uint64(len(tokens))])).view(np.int64)[0])


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """For each bit whether an odd number of tokens fall there."""
    lo, hi = SKETCH_BYTES
    bits = min(8 * hi, max(8 * lo, 1 << (len(tokens) - 1).bit_length()))
    at = (ts.mix(tokens ^ _SEEDS[6]) & np.uint64(bits - 1)).view(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def narrowed(wide: bytes, size: int) -> bytes:
    """The sketch that ``size`` bytes would have given."""
    x = np.frombuffer(wide, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.tobytes()


def _close(differ, na, nb):
    """Whether sets of ``na`` and ``nb`` tokens whose sketches differ in so many bits may be similar."""
    return (NUM + DEN) * differ <= (DEN - NUM) * (na + nb)


def sketches_fit(x: bytes, nx: int, y: bytes, ny: int) -> bool:
    size = min(len(x), len(y))
    x, y = narrowed(x, size), narrowed(y, size)
    return _close((int.from_bytes(x) ^ int.from_bytes(y)).bit_count(), nx, ny)


def _fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("s_a", "n_a", "s_b", "n_b")]
        yield batch.select(["a", "b"]).filter(pa.array([sketches_fit(*row) for row in zip(*cols)], pa.bool_()))


class Frequent:
    """Frequent tokens, sorted, and how frequent each is (1 to 40)."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.level = np.log2(np.maximum(counts[order], 1)).astype(np.uint64) + np.uint64(1)

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.uint64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.level[at], np.uint64(0))

    def prefix(self, tokens: np.ndarray, k: int) -> np.ndarray:
        """First tokens of a sorted set under order ``k``."""
        key = (self.levels(tokens) << np.uint64(58)) | (ts.mix(tokens ^ _SEEDS[k + 1]) >> np.uint64(6))
        return tokens[np.argsort(key, kind="stable")[: prefix_length(len(tokens))]]


def _scan_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and rows with token and count for tokens frequent in this slice of the input."""
    known: set[int] = set()
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
        often = n >= LOCAL_DF
        return _batch(ids.slice(0, 0).take(pa.array([None] * int(often.sum()), pa.int64())), None, None, None, _signed(tokens[often]), n[often], None, None)

    ids = None
    for batch in batches:
        ids = batch.column("doc_id")
        for piece in ts.slices(batch.column("text")):
            count, node, wide, narrow = np.zeros(piece.hi - piece.lo, np.int64), [], [], []
            for i, tokens in shingle_sets(piece):
                own = node_of(tokens)
                count[i] = len(tokens)
                node.append(own)
                wide.append(None)
                narrow.append(None)
                if own is not None and own not in known:
                    known.add(own)
                    held.append(tokens)
                    size += len(tokens)
                    wide[-1] = sketch(tokens)
                    if len(wide[-1]) > SKETCH_BYTES[0]:
                        narrow[-1] = narrowed(wide[-1], SKETCH_BYTES[0])
            rows = slice(piece.lo, piece.hi)
            yield _batch(ids[rows], batch.column("k1")[rows], count, node, None, None, wide, narrow)
            if size >= COUNT_TOKENS:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def _batch(ids: pa.Array, k1, count, node, token, n, wide, narrow) -> pa.RecordBatch:
    rows = len(ids)
    col = lambda x: pa.nulls(rows, pa.int64()) if x is None else pa.array(x, pa.int64()) if not isinstance(x, pa.Array) else x
    raw = [pa.nulls(rows, pa.binary()) if x is None else pa.array(x, pa.binary()) for x in (wide, narrow)]
    return pa.RecordBatch.from_arrays([ids, *map(col, (k1, count, node, token, n)), *raw], names=["doc_id", "k1", "n_shingles", "node", "token", "df", "sketch", "narrow"])


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text).alias("k1"), text.alias("text"))


def _frequent(counts: DataFrame) -> Frequent:
    """The most frequent tokens: all from some count on, as many as the list may hold."""
    total = _stored(counts.groupBy("token").agg(F.sum("df").alias("df")), "df")
    room, least = MAX_FREQUENT, None
    for r in total.groupBy("df").count().orderBy(F.desc("df")).toLocalIterator():
        room -= r["count"]
        if room < 0:
            break
        least = r["df"]
    top = total.filter(F.col("df") >= (least if least is not None else 1 << 62)).toPandas()
    return Frequent(top["token"].to_numpy(np.int64).view(np.uint64), top["df"].to_numpy(np.int64))


def _prefixes(texts: DataFrame, frequent) -> DataFrame:
    """(token, node, n, pos) for each prefix token of each set under the first order; copies within a task give one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, known = frequent.value, set()
        for batch in batches:
            for piece in ts.slices(batch.column("text")):
                out = []
                for _, tokens in shingle_sets(piece):
                    node = node_of(tokens)
                    if node is not None and node not in known:
                        known.add(node)
                        out.append((order.prefix(tokens, 0), node, len(tokens)))
                if out:
                    size = np.array([len(p) for p, _, _ in out])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_signed(np.concatenate([p for p, _, _ in out]))),
                            pa.array(np.repeat(np.array([x for _, x, _ in out], np.int64), size)),
                            pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), size)),
                            pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in size])),
                        ],
                        names=["token", "node", "n", "pos"],
                    )

    return texts.select("text").mapInArrow(scan, "token long, node long, n int, pos int")


def _may_link(na, pa_, nb, pb) -> np.ndarray:
    """Length and position filters for a token at places ``pa_`` and ``pb`` of sets of ``na`` and ``nb`` tokens.

    They hold for the first token that two similar sets share, which is enough:
    the pair comes up there, and no more can be shared than is left behind it.
    """
    long = DEN * np.minimum(na, nb) >= NUM * np.maximum(na, nb)
    best = np.minimum(na - pa_, nb - pb)
    return long & (best * (NUM + DEN) >= NUM * (na + nb))


def _whole(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    """A partition's rows; how many there are is bounded by the number of partitions."""
    kept = [[b.column(c).to_numpy(zero_copy_only=False) for c in names] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*kept)] if kept else [np.empty(0, np.int64) for _ in names]


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    if len(lo):
        both = np.unique(np.stack([lo, hi], 1), axis=0)
        for at in range(0, len(both), 100_000):
            part = both[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[:, 0])), pa.array(np.ascontiguousarray(part[:, 1]))], names=["a", "b"])


def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition dealt by token: the rows that some other node's row may link with, each (token, node) once.

    In groups of more than PROBED nodes all rows count as such. Each row knows two centres of its token, the nodes of least
    hash under two seeds, and whether it may link with them.
    """
    token, node, n, pos = _whole(batches, ["token", "node", "n", "pos"])
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    if not len(order):
        return
    new = np.ones(len(order), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    order, token = order[new], token[new]
    cols = [token, node[new], n[order], pos[order]]
    by_size = np.lexsort((cols[2], token))
    cols = token, _, n, pos = [c[by_size] for c in cols]
    head = np.append(True, token[1:] != token[:-1])
    size = np.diff(np.append(np.flatnonzero(head), len(token)))
    fits = np.repeat(size > PROBED, size)
    live = np.flatnonzero(~fits)
    for d in range(1, PROBED):
        live = live[live + d < len(token)]
        live = live[(token[live] == token[live + d]) & (DEN * n[live] >= NUM * n[live + d])]
        if not len(live):
            break
        hit = live[_may_link(n[live], pos[live], n[live + d], pos[live + d])]
        fits[hit] = fits[hit + d] = True
    cols = [c[fits] for c in cols]
    names = ["token", "node", "n", "pos"]
    for k in CENTRES:
        at = _centres(cols[0], cols[1], k)
        cols += [cols[1][at], _may_link(cols[2], cols[3], cols[2][at], cols[3][at])]
        names += [f"centre{k}", f"near{k}"]
    for at in range(0, len(cols[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[at : at + 100_000])) for c in cols], names=names)


def _centres(token: np.ndarray, node: np.ndarray, seed: int) -> np.ndarray:
    """For each row the place of its token's node of least hash; rows of a token stand together."""
    if not len(token):
        return np.empty(0, np.int64)
    order = np.lexsort((ts.mix(node.view(np.uint64) ^ _SEEDS[seed]), token))
    first = np.append(True, token[order][1:] != token[order][:-1])
    out = np.empty(len(token), np.int64)
    out[order] = order[np.flatnonzero(first)][np.cumsum(first) - 1]
    return out


def _cross_pairs(batches: Iterator[pa.RecordBatch], forest: bool = False) -> Iterator[pa.RecordBatch]:
    """All pairs of a token's documents that are in different components and pass the filters.

    One of the two is outside the token's largest component, so only such rows look for partners, among the longer
    sets (all of them) and the shorter ones (those of the largest component). Where rows have sketches, these must fit too.
    With ``forest`` only pairs whose components no other pairs of the task connect.
    """
    sketches: list[np.ndarray] = []
    token, node, n, pos, comp = _whole(_split_off(batches, sketches), ["token", "node", "n", "pos", "comp"])
    order = np.lexsort((n, token))
    token, node, n, pos, comp = (x[order] for x in (token, node, n, pos, comp))
    marks = np.concatenate(sketches)[order] if sketches else None
    largest = _largest(token, comp)
    outside = np.flatnonzero(~largest)
    left, right, held = [], [], 0
    tree = _Forest(comp) if forest else None
    for step in (1, -1):
        live, d = outside, step
        while True:
            live = live[(live + d < len(token)) & (live + d >= 0)]
            j = live + d
            short, long = (live, j) if step > 0 else (j, live)
            live = live[(token[live] == token[j]) & (DEN * n[short] >= NUM * n[long])]  # sorted by size: none further off fits
            if not len(live):
                break
            j = live + d
            hit = (comp[live] != comp[j]) & _may_link(n[live], pos[live], n[j], pos[j])
            if step < 0:
                hit &= largest[j]
            if marks is not None and hit.any():
                at = np.flatnonzero(hit)
                i, k = live[at], j[at]
                hit[at] = _close(np.bitwise_count(marks[i] ^ marks[k]).sum(axis=1, dtype=np.int64), n[i].astype(np.int64), n[k].astype(np.int64))
            if tree is not None:
                at = np.flatnonzero(hit)
                hit[at] = tree.connects(live[at], j[at])
            left.append(live[hit])
            right.append(j[hit])
            held += len(left[-1])
            if held > 500_000:
                yield from _pairs(node[np.concatenate(left)], node[np.concatenate(right)])
                left, right, held = [], [], 0
            d += step
    if held:
        yield from _pairs(node[np.concatenate(left)], node[np.concatenate(right)])


def _cross_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task's pairs across components a forest: fewer pairs than it has components, and if all are similar, all that matters."""
    yield from _cross_pairs(batches, forest=True)


class _Forest:
    """Which pairs of rows connect components that pairs before them do not."""

    def __init__(self, comp: np.ndarray):
        known, self.of = np.unique(comp, return_inverse=True)
        self.up = np.arange(len(known)).tolist()

    def _root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def connects(self, left: np.ndarray, right: np.ndarray) -> list[bool]:
        out = []
        for i, j in zip(self.of[left].tolist(), self.of[right].tolist()):
            i, j = self._root(i), self._root(j)
            out.append(i != j)
            self.up[max(i, j)] = min(i, j)
        return out


def _split_off(batches: Iterator[pa.RecordBatch], into: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The batches as they are; their sketches, if there are any, go to ``into``, a row of 64-bit words each."""
    for batch in batches:
        if batch.num_rows and "narrow" in batch.schema.names:
            raw = b"".join(batch.column("narrow").to_pylist())
            into.append(np.frombuffer(raw, np.uint64).reshape(batch.num_rows, SKETCH_BYTES[0] // 8))
        yield batch


def _largest(token: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Whether each row belongs to the component that has most rows of its token."""
    if not len(token):
        return np.empty(0, bool)
    order = np.lexsort((comp, token))
    t, c = token[order], comp[order]
    new = np.append(True, (t[1:] != t[:-1]) | (c[1:] != c[:-1]))
    size = np.diff(np.append(np.flatnonzero(new), len(t)))
    owner = t[new]
    by = np.lexsort((-size, owner))
    best = np.zeros(len(size), bool)
    best[by[np.append(True, owner[by][1:] != owner[by][:-1])]] = True
    out = np.empty(len(token), bool)
    out[order] = np.repeat(best, size)
    return out


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for each key, a 64-bit hash; its size is fixed, and a bit too many costs only time."""
    spot = F.pmod(F.col(keys.columns[0]), F.lit(BITMAP_BITS))
    words = keys.select(F.floor(spot / 32).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 32).cast("int")).alias("bit"))
    rows = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITMAP_BITS // 32, np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.astype(np.uint32)


def _sets(texts: DataFrame, wanted) -> DataFrame:
    """(node, tokens) of the documents whose text may be among the wanted ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = wanted.value, set()
        for batch in batches:
            spot = batch.column("k1").to_numpy() % BITMAP_BITS
            may = (bits[spot >> 5] >> (spot & 31).astype(np.uint32)) & 1
            texts = batch.column("text").filter(pa.array(may.astype(bool)))
            for piece in ts.slices(texts):
                nodes, sets = [], []
                for _, tokens in shingle_sets(piece):
                    node = node_of(tokens)
                    if node is not None and node not in known:
                        known.add(node)
                        nodes.append(node)
                        sets.append(tokens.tobytes())
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return texts.select("k1", "text").mapInArrow(scan, "node long, tokens binary").dropDuplicates(["node"])


def leads(tokens: np.ndarray, order: Frequent) -> np.ndarray:
    """Prefixes of a set under all orders but the first, one after the other."""
    return np.concatenate([order.prefix(tokens, k) for k in range(1, ORDERS)])


def leads_meet(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> bool:
    """Whether two sets share a prefix token under each further order, early enough in both."""
    p, q = prefix_length(nx), prefix_length(ny)
    for k in range(ORDERS - 1):
        own, other = x[k * p : (k + 1) * p], y[k * q : (k + 1) * q]
        shared = np.flatnonzero(np.isin(own, other, assume_unique=True))
        if not len(shared):
            return False
        i = int(shared[0])  # the first one that both share, in their common order
        if not _may_link(nx, i, ny, int(np.flatnonzero(other == own[i])[0])):
            return False
    return True


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * DEN >= NUM * (len(x) + len(y) - both)


def similar(x: np.ndarray, y: np.ndarray, order: Frequent) -> bool:
    """The further orders' filters, then the sets themselves."""
    return leads_meet(leads(x, order), len(x), leads(y, order), len(y)) and alike(x, y)


def _tokens(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.uint64)


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, sketches: DataFrame, frequent) -> DataFrame:
    """The pairs whose sets are similar. Only sets of nodes in pairs that their sketches allow are made, from their texts, and
    each is moved once to its node's pairs; ``b`` should be the end that many pairs have in common."""
    for end in "ab":
        pairs = pairs.join(sketches.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}")), end)
    pairs = _stored(pairs.select("a", "b", "s_a", "n_a", "s_b", "n_b").mapInArrow(_fitting, "a long, b long"), "pairs")
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    one_text = nodes.join(ends, "node", "left_semi").groupBy("node").agg(F.min("k1").alias("k1")).select("k1")
    sets = _sets(texts, pairs.sparkSession.sparkContext.broadcast(_bitmap(one_text)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, last, y, lead_y = frequent.value, None, None, None
        for batch in batches:
            keep = []
            for x, b, cell in zip(batch.column("x"), batch.column("b").to_pylist(), batch.column("y")):
                if b != last:
                    last, y = b, _tokens(cell).copy()
                    lead_y = leads(y, order)
                x = _tokens(x)
                keep.append(leads_meet(leads(x, order), len(x), lead_y, len(y)) and alike(x, y))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for end, mark in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("tokens").alias(mark)), end)
    return pairs.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    own = pairs
    for end in "ab":
        own = own.join(comps.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return own.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).drop("of_a", "of_b")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links."""
    if links.isEmpty():
        return comps
    return components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def tasks_for(rows: int, wanted: int) -> int:
    """How many tasks ``rows`` prefix rows are dealt to: as many as ``wanted`` within the bounds of rows in a task."""
    return max(1, min(wanted, -(-rows // LEAST_ROWS)), -(-rows // ROWS_PER_TASK))


def _links(texts: DataFrame, nodes: DataFrame, shared: DataFrame, frequent, parts: int) -> DataFrame:
    """Components (node, component) of all links: most votes first, then all centres, then all pairs still apart. No pair is compared twice."""
    first, second = CENTRES
    drawn = nodes.filter("sketch IS NOT NULL").join(shared.select("node").distinct(), "node", "left_semi")
    drawn = drawn.select("node", F.col("n_shingles").alias("n"), "sketch", F.coalesce("narrow", "sketch").alias("narrow")).dropDuplicates(["node"])
    sketches = _stored(drawn, "sketches")
    ends = [shared.select(F.col("node").alias("a"), F.col(f"centre{k}").alias("b"), F.col(f"near{k}").cast("int").alias("votes"), F.lit(k == first).alias("own")) for k in (first, second)]
    stars = _stored(ends[0].unionByName(ends[1]).filter("a <> b").groupBy("a", "b").agg(F.sum("votes").alias("votes"), F.max("own").alias("own")), "stars")
    best = stars.filter("votes > 0").groupBy("a").agg(F.max_by("b", F.struct("votes", "b")).alias("b"))
    comps = components(_verified(best, texts, nodes, sketches, frequent))

    def open_rows() -> DataFrame:
        # A token all of whose nodes are in its first centre's component has no pair left.
        split = _apart(stars.filter("own"), comps).select(F.col("a").alias("node"), F.col("b").alias(f"centre{first}"))
        open_tokens = shared.join(split, ["node", f"centre{first}"], "left_semi").select("token").distinct()
        rows = shared.select("token", "node", "n", "pos").join(open_tokens, "token", "left_semi").join(comps, "node", "left").join(sketches.select("node", "narrow"), "node")
        return rows.select("token", "node", "n", "pos", F.coalesce("component", "node").alias("comp"), "narrow").repartition(parts, "token")

    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _apart(stars.filter("votes > 0"), comps).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.unionByName(open_rows().mapInArrow(_cross_forest, "a long, b long")).distinct()
    rest = _stored(rest.join(best, ["a", "b"], "left_anti"), "rest")
    comps = _merged(comps, _stored(_verified(rest, texts, nodes, sketches, frequent), "links"))

    cross = open_rows().mapInArrow(_cross_pairs, "a long, b long").distinct()
    cross = cross.join(best.unionByName(rest), ["a", "b"], "left_anti")
    return _merged(comps, _stored(_verified(cross, texts, nodes, sketches, frequent), "links"))


def _groups(docs: DataFrame) -> DataFrame:
    """doc_id, k1 (hash of the text), n_shingles, component_id."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = _texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scanned = _stored(texts.mapInArrow(_scan_nodes, f"doc_id {kind}, k1 long, n_shingles long, node long, token long, df long, sketch binary, narrow binary"), "nodes")
    nodes = scanned.filter(F.col("token").isNull()).drop("token", "df")
    frequent = sc.broadcast(_frequent(scanned.filter(F.col("token").isNotNull())))

    n = F.col("n_shingles")
    rows = nodes.filter(n > 0).agg(F.coalesce(F.sum(n - F.ceil(n * NUM / DEN) + 1), F.lit(0))).first()[0]
    parts = tasks_for(int(rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = "token long, node long, n int, pos int, " + ", ".join(f"centre{k} long, near{k} boolean" for k in CENTRES)
    shared = _stored(_prefixes(texts, frequent).repartition(parts, "token").mapInArrow(_group_rows, made), "shared")
    comps = _links(texts, nodes, shared, frequent, parts)

    classes = nodes.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = classes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return (
        nodes.join(placed.join(least, "component").select("node", "component_id"), "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "k1", "n_shingles", "component_id")
    )


def group(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs``."""
    return _groups(docs).drop("k1")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the row with its least doc_id, with all columns."""
    found = _stored(_groups(docs), "groups").select(F.col("doc_id").alias("own"), F.col("k1").alias("key"), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    # the columns of docs travel in one, so that none of their names can clash
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("k1"))
    same = F.col("id").eqNullSafe(F.col("own")) & (F.col("k1") == F.col("key"))
    out = rows.join(found.filter("NOT stays").select("own", "key").distinct(), same, "left_anti")
    twice = found.filter("stays AND own IS NOT NULL").groupBy("own", "key").count().filter("count > 1").select("own", "key")
    if not twice.isEmpty():
        again = out.join(twice, same, "left_semi").dropDuplicates(["id", "k1"])
        out = out.join(twice, same, "left_anti").unionByName(again)
    return out.select("doc.*")
