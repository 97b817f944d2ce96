"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, runs of ASCII white space to one space,
digits to 0) and hashed. Per host the documents that contain a line are
counted; lines above the host's limit are common lines. A document loses its
common lines and is rejected as depleted if too few of its words are left, or
by the base rules on its own text.

Copies must not make their own lines common: equal texts of a host are one
document, and for each line the documents are told apart by their anchor, the
least hash among their other lines. A thousand near copies share most anchors;
a thousand pages with one footer do not. Lines on more than half of a host's
distinct texts are its template and are no anchors while a document has other
lines, so pages of many template lines and one line of their own count one by
one. Documents that differ only in digits have no lines of their own; they
count as copies.

Edge cases: a null or empty text has no words and fails the base rules; a null
host is a host of its own; repeated rows all get the verdict of their text; an
empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.session import scratch_path

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: A line is common in a host if more documents have it than both the number and the share of the host's documents.
COMMON_DOCS = 20
COMMON_PER_MILLE = 5
#: A host's texts meet its template lines in so many parts.
SALTS = 32
#: Percent of its words a document must keep once common lines are gone.
KEEP_PCT = 20

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", b"abcdefghijklmnopqrstuvwxyz0000000000")
_WORD = ts.not_space_lut(fold_case=False)
_BREAK = np.arange(256) == 10
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCANNED = pa.schema(
    [("row", pa.int64()), *((c, pa.int64()) for c in _BASE), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))]
)


def base_counts(piece: ts.Slice) -> dict[str, np.ndarray]:
    """Counts of the base rules for each text of a slice."""
    n = piece.hi - piece.lo
    codes = _WORD[piece.buf]
    inside = codes != 0
    start, end = ts.edges(inside, piece.off)
    doc = np.searchsorted(piece.off, start, "right") - 1
    sums = ts.prefix_hashes(piece.buf)
    w = ts.Words(start, end, doc, ts.span_hashes(sums, start, end))
    out = {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": ts.per_doc(inside & ((piece.buf & 0xC0) != 0x80), piece.off),
        "n_symbols": ts.per_doc(_SYMBOL[piece.buf], piece.off),
    }
    # lines are cut at \n and at the bounds of texts; those without a word do not count
    cuts = np.flatnonzero(_BREAK[piece.buf])
    begin = np.unique(np.concatenate([piece.off[:-1], cuts + 1])) if len(piece.buf) else np.empty(0, np.int64)
    begin = begin[begin < len(piece.buf)]
    stop = np.append(begin[1:], len(piece.buf))[: len(begin)]
    stop = stop - _BREAK[piece.buf[stop - 1]]
    has_word = np.append(start, len(piece.buf))[np.searchsorted(start, begin)] < stop
    begin, stop = begin[has_word], stop[has_word]
    line_doc = np.searchsorted(piece.off, begin, "right") - 1
    keys = np.unique(ts.span_hashes(sums, begin, stop) ^ ts.mix(line_doc.astype(np.uint64) + np.uint64(1)), return_index=True)
    out["n_dup_lines"] = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[keys[1]], minlength=n)
    # words covered by windows that occur again in their text
    h, whole = ts.windows(w, WINDOW)
    at = np.flatnonzero(whole)
    h = h[at] ^ ts.mix(doc[at].astype(np.uint64) + np.uint64(1))
    order = np.sort(h)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if len(twice):
        spot = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        at = at[twice[spot] == h]
        delta = np.zeros(len(start) + 1, np.int64)
        np.add.at(delta, at, 1)
        np.add.at(delta, at + WINDOW, -1)
        covered = np.cumsum(delta[:-1]) > 0
        out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    else:
        out["n_repeat_words"] = np.zeros(n, np.int64)
    return out


def line_key(line: bytes) -> tuple[int, int]:
    """Hash and number of words of a normalised line; a line without a word has neither."""
    parts = line.translate(_FOLD).split()
    return (int.from_bytes(hashlib.md5(b" ".join(parts), usedforsecurity=False).digest()[:8], "big") if parts else 0), len(parts)


def without(text: str, lines: set[int]) -> str:
    """The text without the lines of these (signed) hashes."""
    sign = lambda k: k - (1 << 64) if k >> 63 else k
    keys = ((x, line_key(x)) for x in text.encode().split(b"\n"))
    return b"\n".join(x for x, (k, n) in keys if not n or sign(k) not in lines).decode()


def line_entries(text: bytes) -> list[tuple[int, int]]:
    """Each distinct normalised line of a text: its hash and its words over all repeats, least hashes first."""
    found: dict[int, int] = {}
    for line in text.split(b"\n"):
        key, n = line_key(line)
        if n:
            found[key] = found.get(key, 0) + n
    return sorted(found.items())


def _list_column(lines: list[list[tuple[int, int]]]) -> pa.Array:
    flat = [x for own in lines for x in own]
    key, n = (np.array(c, np.uint64) for c in zip(*flat)) if flat else (np.empty(0, np.uint64),) * 2
    off = np.concatenate([[0], np.cumsum([len(own) for own in lines])]).astype(np.int32)
    kind = _SCANNED.field("lines").type.value_type
    return pa.ListArray.from_arrays(off, pa.StructArray.from_arrays([pa.array(c.view(np.int64)) for c in (key, n)], fields=list(kind)))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    for batch in batches:
        for piece in ts.slices(batch.column("text")):
            n = piece.hi - piece.lo
            counts = base_counts(piece)
            raw, off = piece.buf.tobytes(), piece.off
            lines = [line_entries(raw[off[i] : off[i + 1]]) for i in range(n)]
            given = [batch.column(c).slice(piece.lo, n) for c in ("doc_id", "host", "k1", "k2")]
            own = [pa.array(np.arange(row, row + n)), *(pa.array(counts[c]) for c in _BASE), _list_column(lines)]
            row += n
            yield pa.RecordBatch.from_arrays(given + own, names=["doc_id", "host", "k1", "k2", *_SCANNED.names])


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """Equal texts have equal (k1, k2)."""
    return docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"), F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), F.col("text").cast("string").alias("text"))


def _other(least: str) -> Column:
    """The first of up to two lines that is not ``line`` itself; null if there is none."""
    first, second = F.get(least, F.lit(0)), F.get(least, F.lit(1))
    return F.when(first != F.col("line"), first).otherwise(second)


def _judged(docs: DataFrame, host: str = "source", common_docs: int = COMMON_DOCS, common_per_mille: int = COMMON_PER_MILLE, keep_pct: int = KEEP_PCT) -> tuple[DataFrame, DataFrame]:
    """Verdicts by row number, and each row's common lines."""
    spark = docs.sparkSession
    keyed = _keyed(docs, host)
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema}
    shape = f"doc_id {kinds['doc_id']}, host string, k1 bigint, k2 int, row bigint, {', '.join(f'{c} bigint' for c in _BASE)}, lines array<struct<line:bigint,words:bigint>>"
    path = scratch_path(spark, "lines")
    keyed.mapInArrow(_scan, shape).write.parquet(path)
    rows = spark.read.parquet(path)
    lines = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.*")

    firsts = rows.groupBy("host", "k1", "k2").agg(F.min("row").alias("row"))
    sizes = firsts.groupBy("host").agg(F.count("*").alias("host_docs"))
    texts = rows.select("row", "host", F.col("lines.line").alias("keys")).join(firsts.select("row"), "row", "left_semi")
    on = texts.select("host", F.explode("keys").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > common_docs)
    templates = on.join(sizes, "host").filter(2 * F.col("n") > F.col("host_docs")).groupBy("host").agg(F.collect_list("line").alias("template"))
    # keys are in the order of the scan, which sorts them as unsigned numbers
    salted = templates.withColumn("salt", F.explode(F.array(*(F.lit(i).cast("long") for i in range(SALTS)))))
    told = texts.withColumn("salt", F.pmod("row", F.lit(SALTS))).join(salted, ["host", "salt"], "left").withColumn("own", F.array_except("keys", F.coalesce("template", F.array().cast("array<bigint>"))))
    seen = (
        told.select("host", F.slice("own", 1, 2).alias("own"), F.slice("keys", 1, 2).alias("low"), F.explode("keys").alias("line"))
        .select("host", "line", F.coalesce(_other("own"), _other("low"), F.col("line")).alias("anchor"))
        .groupBy("host", "line", "anchor")
        .agg(F.lit(1).alias("one"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("line_docs"))
        .filter(F.col("line_docs") > common_docs)
    )
    common = seen.join(sizes, "host").filter(F.col("line_docs") * 1000 > F.col("host_docs") * common_per_mille).select("host", "line")
    hits = lines.join(common, ["host", "line"])
    lost = hits.groupBy("row").agg(F.sum("words").alias("lost"))

    n_common = F.coalesce("lost", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    verdicts = (
        rows.drop("lines")
        .join(lost, "row", "left")
        .withColumn("n_common_words", n_common)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ((F.col("n_words") - F.col("n_common_words")) * 100 >= F.col("n_words") * keep_pct))
        .drop("lost")
    )
    return verdicts, hits


def judge(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """One row per row of ``docs``: base counts, words in common lines, and the verdict.

    ``k1`` and ``k2`` hash the text, so that equal texts can be told outside.
    Texts are read once; the scan's counts and line hashes are stored below
    ``spark.checkpoint.dir`` and all later steps read those.
    """
    return _judged(docs, host, **limits)[0].drop("row")


def keep(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    bad = judge(docs, host, **limits).filter(~F.col("kept")).select("host", "k1", "k2").distinct()
    same = [F.coalesce(F.col(host).cast("string"), F.lit("\x00")) == bad["host"], F.xxhash64("text") == bad["k1"], F.hash("text") == bad["k2"]]
    return docs.join(bad, same, "left_anti")


def clean(docs: DataFrame, host: str = "source", n_chars: str | None = "n_chars", **limits: int) -> DataFrame:
    """The rows that :func:`keep` keeps, without common lines in ``text``; ``n_chars``, if there is such a column, follows."""
    verdicts, hits = _judged(docs, host, **limits)
    texts = verdicts.groupBy("host", "k1", "k2").agg(F.min("row").alias("row"), F.min("kept").alias("kept"), F.max("n_common_words").alias("n"))
    cuts = hits.groupBy("row").agg(F.collect_set("line").alias("cut"))
    fate = texts.filter(~F.col("kept") | (F.col("n") > 0)).join(cuts, "row", "left").select("host", "k1", "k2", "kept", "cut")
    keys = [F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"), F.xxhash64("text").alias("k1"), F.hash("text").alias("k2")]
    rows = docs.select(F.struct(*docs.columns).alias("doc"), *keys).join(fate, ["host", "k1", "k2"], "left").filter(F.coalesce("kept", F.lit(True))).select("doc", "cut")
    at = docs.columns.index("text")
    count = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("doc").flatten()[at]
            for piece in ts.slices(texts):
                part = batch.slice(piece.lo, piece.hi - piece.lo)
                doc = part.column("doc")
                cols, names = doc.flatten(), [f.name for f in doc.type]
                lines = part.column("cut").to_pylist()
                if any(lines):
                    old = cols[at].to_pylist()
                    new = [without(t, set(own)) if own else t for t, own in zip(old, lines)]
                    cols[at] = pa.array(new, cols[at].type)
                    if count is not None:
                        cols[count] = pa.array([len(t) if own else c for t, own, c in zip(new, lines, cols[count].to_pylist())], cols[count].type)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(cut, docs.schema)
