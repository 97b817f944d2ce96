"""Quality classifier by co-training of two views.

One classifier sees what a document says (hashed words and the shape of its
text), another only its metadata (source, language, length). Over some rounds
each marks the unlabelled documents it is surest of, in the proportion of the
labels and only where its calibrated probability is high, and these
pseudo-labels train the other. Each view is then calibrated
on labelled rows kept aside, the calibrated log-odds of both are weighted on
those rows, and all documents are scored.

In every round both views score the whole unlabelled table as a Spark job, and
the surest documents are told by a histogram over all of it. Only the rows that
fit a classifier are bounded: LABELLED labelled ones, and LENT pseudo-labelled
ones a view, drawn by hash from all that are lent.

Edge cases: a null or empty text, source, language or length has features of
its own; a doc_id that is labelled in both ways counts by its mean; without
labels of both kinds every score is the share of good labels, or 1/2, and all
rows are kept; repeated rows are scored each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.session import scratch_path

#: Most labelled rows that fit a classifier, and most pseudo-labelled ones.
LABELLED = 6_000
LENT = 4_000
ROUNDS = 4
#: Share of the unlabelled documents that each view labels for the other in a round, beside as many for each round before.
SHARE = 0.05
#: Steps of the histogram for each unit of log-odds, and the greatest log-odds.
STEPS = 64
MOST_ODDS = 30
#: Least calibrated probability of a pseudo-label; a view that is never so sure lends none.
CONFIDENT = 0.95
#: Every so many labelled rows are kept aside for calibration.
HELD_OUT = 4
WORD_BITS = 9
SOURCE_BITS = 7
LANG_BITS = 5
#: Documents below this probability of being good are not kept.
LEAST = 0.5

_LUT = ts.not_space_lut(fold_case=True)
_CLASSES = ("letters", "capitals", "digits", "symbols", "high")
_CLASS = np.full(256, 3, np.uint8)
_CLASS[list(ts.ASCII_SPACE)] = 5
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[128:] = 4
TEXT_WIDTH = (1 << WORD_BITS) + 13
META_WIDTH = (1 << SOURCE_BITS) + (1 << LANG_BITS) + 14


def text_view(piece: ts.Slice) -> np.ndarray:
    """Features of each text of a slice: its hashed words, of length 1, and the shape of the text."""
    n = piece.hi - piece.lo
    w = ts.words(piece, _LUT)
    width = 1 << WORD_BITS
    bag = np.bincount(w.doc * width + (w.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=n * width).reshape(n, width)
    bag = np.log1p(bag)
    bag /= np.maximum(np.sqrt((bag * bag).sum(1, keepdims=True)), 1e-9)
    size = np.maximum(np.diff(piece.off), 1)
    kinds = _CLASS[piece.buf]
    shape = [ts.per_doc(kinds == k, piece.off) / size for k in range(len(_CLASSES))]
    words = np.bincount(w.doc, minlength=n)
    some = np.maximum(words, 1)
    once = lambda keys: np.bincount(w.doc[np.unique(keys ^ ts.mix(w.doc.astype(np.uint64) + np.uint64(1)), return_index=True)[1]], minlength=n)
    shape.append(once(w.hash) / some)
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape.append(np.bincount(w.doc[again], minlength=n) / some)
    ends = piece.buf[w.end - 1] if len(w.end) else np.empty(0, np.uint8)
    shape.append(np.bincount(w.doc[_CLASS[ends] == 3], minlength=n) / some)
    shape.append(np.bincount(w.doc[w.end - w.start == 1], minlength=n) / some)
    shape.append(np.bincount(w.doc, weights=(w.end - w.start), minlength=n) / some / 10)
    shape.append(ts.per_doc(piece.buf == 10, piece.off) / some)
    shape.append(np.log1p(words) / 10)
    shape.append(words == 0)
    return np.hstack([bag, np.stack(shape, 1)]).astype(np.float32)


def _slot(values: list[str | None], bits: int) -> np.ndarray:
    """Hashed place of each value; null has a place like any other."""
    raw = pa.array(["\x00" if v is None else v for v in values], pa.string())
    out = np.empty(len(values), np.int64)
    for p in ts.slices(raw):
        sums = ts.prefix_hashes(p.buf)
        out[p.lo : p.hi] = (ts.span_hashes(sums, p.off[:-1], p.off[1:]) >> np.uint64(64 - bits)).astype(np.int64)
    return out


def meta_view(source: list[str | None], lang: list[str | None], n_chars: np.ndarray) -> np.ndarray:
    """Features of the metadata: hashed source and language, and the length in steps."""
    n = len(source)
    out = np.zeros((n, META_WIDTH), np.float32)
    rows = np.arange(n)
    out[rows, _slot(source, SOURCE_BITS)] = 1
    out[rows, (1 << SOURCE_BITS) + _slot(lang, LANG_BITS)] = 1
    known = np.isfinite(n_chars) & (n_chars >= 0)
    step = np.where(known, np.minimum(np.log2(np.where(known, n_chars, 0) + 1).astype(np.int64), 18) // 2 + 1, 0)
    out[rows, (1 << SOURCE_BITS) + (1 << LANG_BITS) + step] = 1
    return out


@dataclass
class View:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> View:
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-6, scale, np.inf)
        z = (x - mean) / scale
        # both classes weigh the same; accelerated gradient steps of the size that the curvature allows
        weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        v = np.ones(z.shape[1], np.float32)
        for _ in range(12):
            v = z.T @ (weight * (z @ v))
            v /= max(float(np.linalg.norm(v)), 1e-12)
        rate = 1 / (0.25 * float(v @ (z.T @ (weight * (z @ v)))) + 0.25 + penalty)
        w, b = np.zeros(z.shape[1]), 0.0
        w0, b0 = w, b
        for t in range(steps):
            k = t / (t + 3)
            ahead, bias = w + k * (w - w0), b + k * (b - b0)
            error = weight * (1 / (1 + np.exp(-np.clip(z @ ahead + bias, -30, 30))) - y)
            w0, b0 = w, b
            w, b = ahead - rate * (z.T @ error + penalty * ahead), bias - rate * error.sum()
        return cls(mean, scale, w, float(b))

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients and intercept of a small logistic regression, by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    c = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        grad = z.T @ (p - y) + ridge * c
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(c))
        step = np.linalg.solve(hess, grad)
        c = c - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    return c


@dataclass
class CoTrained:
    """Both views, their calibrations, and how the calibrated views are combined."""

    text: View | None
    meta: View | None
    calibration: tuple[np.ndarray, np.ndarray] | None
    combined: np.ndarray | None
    prior: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of being good by the text, by the metadata, and by both."""
        if self.text is None:
            flat = np.full(len(text), self.prior)
            return flat, flat, flat
        odds = [m * c[0] + c[1] for m, c in zip((self.text.margin(text), self.meta.margin(meta)), self.calibration)]
        both = odds[0] * self.combined[0] + odds[1] * self.combined[1] + self.combined[2]
        return tuple(1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in (*odds, both))


Calibration = tuple[np.ndarray, np.ndarray]
#: From both views, their calibrations, the number of the round and the share of good labels: features and labels that train each view.
Lender = Callable[[list[View], Calibration, int, float], list[tuple[np.ndarray, np.ndarray]]]
SURE = float(np.log(CONFIDENT / (1 - CONFIDENT)))


def co_train(x: np.ndarray, m: np.ndarray, y: np.ndarray, px: np.ndarray, pm: np.ndarray, rounds: int = ROUNDS, share: float = SHARE) -> CoTrained:
    """From labelled (x, m, y) and unlabelled (px, pm) features of the two views."""
    lent: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0)) for _ in (0, 1)]
    free = [np.ones(len(px), bool) for _ in (0, 1)]

    def lend(views: list[View], calibration: Calibration, _: int, prior: float) -> list[tuple[np.ndarray, np.ndarray]]:
        for k, (pool, c) in enumerate(zip((px, pm), calibration)):
            # view k labels for the other one, in the proportion of the labels
            odds = views[k].margin(pool) * c[0] + c[1]
            order = np.argsort(odds, kind="stable")
            n = int(len(pool) * share)
            bad = [i for i in order if free[k][i] and odds[i] <= -SURE][: max(1, round(n * (1 - prior)))]
            good = [i for i in order[::-1] if free[k][i] and odds[i] >= SURE][: max(1, round(n * prior))]
            picked, label = np.array([*bad, *good], np.int64), np.concatenate([np.zeros(len(bad)), np.ones(len(good))])
            free[k][picked] = False
            lent[1 - k] = (np.concatenate([lent[1 - k][0], picked]), np.concatenate([lent[1 - k][1], label]))
        return [(pool[ids], labels) for pool, (ids, labels) in zip((px, pm), lent)]

    return co_train_with(x, m, y, lend, rounds if len(px) else 0)


def co_train_with(x: np.ndarray, m: np.ndarray, y: np.ndarray, lend: Lender, rounds: int = ROUNDS) -> CoTrained:
    """From labelled (x, m, y) features of the two views and what ``lend`` gives in each round."""
    prior = float(y.mean()) if len(y) else 0.5
    aside = np.arange(len(y)) % HELD_OUT == 0
    if min((y[aside] == c).sum() for c in (0, 1)) < 2 or min((y[~aside] == c).sum() for c in (0, 1)) < 2:
        return CoTrained(None, None, None, None, prior)
    tx, tm, ty = x[~aside], m[~aside], y[~aside]
    views = [View.fit(tx, ty), View.fit(tm, ty)]
    held = (x[aside], m[aside])

    def calibrated() -> Calibration:
        return tuple(_logistic(v.margin(h)[:, None], y[aside]) for v, h in zip(views, held))

    for r in range(rounds):
        lent = lend(views, calibrated(), r + 1, prior)
        views = [View.fit(np.vstack([own, more]), np.concatenate([ty, labels])) for own, (more, labels) in zip((tx, tm), lent)]
    calibration = calibrated()
    held = [v.margin(h)[:, None] for v, h in zip(views, held)]
    odds = np.hstack([h * c[0] + c[1] for h, c in zip(held, calibration)])
    return CoTrained(views[0], views[1], calibration, _logistic(odds, y[aside]), prior)


def _views(part: pa.RecordBatch) -> Iterator[tuple[ts.Slice, np.ndarray, np.ndarray]]:
    source, lang = part.column("source").to_pylist(), part.column("lang").to_pylist()
    n_chars = part.column("n_chars").cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    for p in ts.slices(part.column("text")):
        rows = slice(p.lo, p.hi)
        yield p, text_view(p), meta_view(source[rows], lang[rows], n_chars[rows])


def _inputs(docs: DataFrame) -> DataFrame:
    text = lambda c: F.col(c).cast("string").alias(c)
    return docs.select("doc_id", text("text"), text("source"), text("lang"), F.col("n_chars").cast("double").alias("n_chars"))


def _features(docs: DataFrame, ids: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the documents in a bounded list of ids, one row an id, by ascending hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, x, m in _views(batch):
                rows = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(p.lo, p.hi - p.lo) for c in ("spot", "y")), rows(x), rows(m)], names=["spot", "y", "x", "m"])

    picked = docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    got = picked.mapInArrow(run, "spot long, y double, x binary, m binary").toPandas().sort_values("spot")
    table = lambda c, width: np.frombuffer(b"".join(got[c]), np.float32).reshape(-1, width)
    return table("x", TEXT_WIDTH), table("m", META_WIDTH), got["y"].to_numpy(np.float64)


def _steps(odds: np.ndarray) -> np.ndarray:
    """How sure log-odds are, in steps: positive for good, negative for bad, 0 for what is not sure."""
    size = np.minimum(np.abs(odds), MOST_ODDS)
    return np.where(size >= SURE, np.sign(odds) * (1 + np.floor((size - SURE) * STEPS)), 0).astype(np.int32)


def _surest(steps: DataFrame, column: str, counts: dict[int, int], sign: int, quota: int, most: int) -> DataFrame | None:
    """At most ``most`` rows drawn by hash from the ``quota`` surest ones of a sign."""
    found = sorted((s * sign for s in counts if s * sign > 0), reverse=True)
    quota = min(quota, sum(counts[s * sign] for s in found))
    if not quota:
        return None
    step = F.col(column) * sign
    if quota <= most:
        return steps.filter(step > 0).orderBy(step.desc(), "spot").limit(quota)
    before = 0
    for s in found:
        if before + counts[s * sign] >= quota:
            break
        before += counts[s * sign]
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < int(1_000_000 * (quota - before) / counts[s * sign])
    return steps.filter((step > s) | (step == s) & part).orderBy("spot").limit(most)


def table_lender(rows: DataFrame, known: DataFrame, lent: int = LENT, share: float = SHARE) -> Lender:
    """Lends from all ``rows`` that have no label in ``known``; each round scores the whole table anew."""
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()

    def lend(views: list[View], calibration: Calibration, r: int, prior: float) -> list[tuple[np.ndarray, np.ndarray]]:
        model = spark.sparkContext.broadcast((views, calibration))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            views, calibration = model.value
            for batch in batches:
                for p, *both in _views(batch):
                    steps = [pa.array(_steps(v.margin(f) * c[0] + c[1])) for v, f, c in zip(views, both, calibration)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(p.lo, p.hi - p.lo), *steps], names=["doc_id", "s0", "s1"])

        path = scratch_path(spark, "cotrain")
        scored = rows.filter(F.col("doc_id").isNotNull()).mapInArrow(score, f"doc_id {kind}, s0 int, s1 int")
        scored.groupBy("doc_id").agg(F.min("s0").alias("s0"), F.min("s1").alias("s1")).join(known, "doc_id", "left_anti").withColumn("spot", F.xxhash64("doc_id")).write.parquet(path)
        steps = spark.read.parquet(path)
        labels: list[dict[int, float]] = []
        ids = {}
        for column in ("s0", "s1"):
            counts = {s: n for s, n in steps.groupBy(column).count().collect()}
            n, own = sum(counts.values()) * share * r, {}
            for sign, part in ((-1, 1 - prior), (1, prior)):
                picked = _surest(steps, column, counts, sign, max(1, round(n * part)), max(1, round(lent * part)))
                for d, s in picked.select("doc_id", "spot").collect() if picked is not None else []:
                    own[s], ids[s] = float(sign > 0), d
            labels.append(own)
        if not ids:
            return [(np.empty((0, w), np.float32), np.empty(0)) for w in (TEXT_WIDTH, META_WIDTH)]
        given = spark.createDataFrame([(d, s, None) for s, d in ids.items()], f"doc_id {kind}, spot long, y double")
        features = _features(rows, given)[:2]
        spots = sorted(ids)
        out = []
        for k, f in enumerate(features):  # what the other view has labelled trains this one
            own = labels[1 - k]
            out.append((f[[s in own for s in spots]], np.array([own[s] for s in spots if s in own])))
        return out

    return lend


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, lent: int = LENT) -> CoTrained:
    """Model from a bounded sample of labelled documents and all unlabelled ones."""
    rows = _inputs(docs)
    spot = F.xxhash64("doc_id").alias("spot")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("y"))
    given = rows.select("doc_id").join(known, "doc_id", "left_semi").distinct().join(known, "doc_id").select("doc_id", spot, "y").orderBy("spot").limit(labelled)
    x, m, y = _features(rows, given)
    return co_train_with(x, m, y, table_lender(rows, known, lent))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", least: float = LEAST) -> DataFrame:
    """doc_id, the views' probabilities p_text and p_meta, their combination score, and kept, for each row of ``docs``."""
    rows = _inputs(docs)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for p, x, m in _views(batch):
                a, b, both = own.scores(x, m)
                kept = both >= least if own.text is not None else np.ones(len(both), bool)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(p.lo, p.hi - p.lo), *map(pa.array, (a, b, both)), pa.array(kept)], names=["doc_id", "p_text", "p_meta", "score", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, p_text double, p_meta double, score double, kept boolean")
