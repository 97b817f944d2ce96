"""Personal data by bootstrapped contextual extraction.

Fixed patterns find emails, ip addresses, card and phone numbers. These seeds
induce lexical patterns - the words around a span - and every other span that
is made like an identifier is an instance that such patterns may know. Spark
holds patterns and instances as a graph and scores it in rounds: a pattern is
as good for a kind as the share of that kind among all different instances it
stands beside, an instance as its best pattern, and instances found so far
strengthen patterns in the next round. Unseen identifiers that a good pattern
stands beside, and that are made as their kind is, become spans of the kinds
``ctx_email`` to ``ctx_phone``. Base spans always stay.

Texts are read once: the scan stores base spans and instances with the hashes
of their patterns, and everything later works on those. Copies of a document
bring no new instances, so they give a pattern no weight.

Edge cases: a null or empty text has no spans; repeated rows and null ids are
scanned row by row; without seeds nothing is added; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.session import cut, scratch_path

KINDS = ("email", "ip", "card", "phone")
ADDED = tuple(f"ctx_{k}" for k in KINDS)
#: Fixed patterns of the base kinds; emails are found from their @ on.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Instances: numbers with their separators, or words with an @ or a digit.
NUMBER = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
WORD = re.compile(r"[A-Za-z0-9@._%+:/-]++")
LEAST_DIGITS, LEAST_WORD = 6, 5
#: Words of a pattern stand within so many characters of the span.
REACH = 48
#: A pattern needs so many different seeds of its kind; an unseen instance the score.
LEAST_SEEDS, LEAST_SCORE = 5, 0.8
#: Instances added to a pattern's count, so that few of them prove less.
DOUBT = 1.0
#: An instance that may be of the kind but is not known yet counts for so much beside a pattern; any other counts whole.
UNKNOWN = 0.25
ROUNDS = 3
SALTS = 16

_ENDS = ".,;:!?\"'()[]{}<>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the email pattern, in time linear in the text: local parts are walked back from each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind as a number) of the base kinds, by start, then kind as listed."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(len(p := g.lstrip("0")) < 4 and int(p or "0") < 256 for g in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            d = _digits(m[0])
            if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and _luhn(d):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return sorted(out, key=lambda s: (s[0], s[2]))


def made_like(span: str) -> int:
    """Kinds, as bits, that an instance may be of by its letters alone."""
    n = len(_digits(span))
    letters = any(c.isalpha() for c in span)
    found = 0
    if "@" in span[1:-1]:
        found |= 1
    if n >= 4 and (span.count(".") >= 3 or span.count(":") >= 3) and not span.strip("0123456789abcdefABCDEF.:"):
        found |= 2
    if n >= 12 and not letters:
        found |= 4
    if LEAST_DIGITS <= n <= PHONE_DIGITS[1] and not letters:
        found |= 8
    return found


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kinds as bits) of unlabelled spans made like identifiers, outside base spans, which part them."""
    out, low = [], 0
    gaps = []
    for a, b, _ in sorted(base):
        if a > low:
            gaps.append((low, a))
        low = max(low, b)
    gaps.append((low, len(text)))
    for a, b in gaps:
        for m in NUMBER.finditer(text, a, b):
            if len(_digits(m[0])) >= LEAST_DIGITS:
                out.append((m.start(), m.end(), made_like(m[0])))
        for m in WORD.finditer(text, a, b):
            w = m[0].rstrip(".:/-")
            if len(w) >= LEAST_WORD and ("@" in w or any("0" <= c <= "9" for c in w)):
                out.append((m.start(), m.start() + len(w), made_like(w)))
    return sorted({s for s in out if s[2]})


def _key(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode(), digest_size=8).digest(), "big", signed=True)


def _norm(words: list[str]) -> list[str]:
    out = []
    for w in words:
        core = w.strip(_ENDS)
        out.append("".join("0" if c.isdigit() else c for c in (core or w).lower()))
    return out


def patterns(text: str, a: int, b: int) -> list[int]:
    """Hashes of the words around a span: the one and the two before it, the ones on both sides, the two behind it."""
    # one character beyond the reach shows whether the outermost word is whole
    left, right = text[max(0, a - REACH - 1) : a].split(), text[b : b + REACH + 1].split()
    if a > REACH + 1 and not text[a - REACH - 1].isspace():
        left = left[1:]
    if b + REACH + 1 < len(text) and not text[b + REACH].isspace():
        right = right[:-1]
    left, right = _norm(left[-2:]), _norm(right[:2])
    out = []
    if left:
        out.append(_key("1", left[-1]))
    if len(left) == 2:
        out.append(_key("2", *left))
    if left and right:
        out.append(_key("3", left[-1], right[0]))
    if len(right) == 2:
        out.append(_key("4", *right))
    return out


_SPAN = "struct<start:int,end:int,kind:int,inst:bigint,patterns:array<bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("inst", pa.int64()), ("patterns", pa.list_(pa.int64()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        for piece in ts.slices(batch.column("text")):
            raw, off, n = piece.buf.tobytes(), piece.off, piece.hi - piece.lo
            counts, sums, base, more = [[] for _ in KINDS], [], [], []
            for p, q in zip(off[:-1], off[1:]):
                t = raw[p:q].decode()
                own = base_spans(t)
                for k, c in enumerate(counts):
                    c.append(sum(s[2] == k for s in own))
                sums.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in own).encode()).hexdigest())
                row_of = lambda s: {"start": s[0], "end": s[1], "kind": s[2], "inst": _key(t[s[0] : s[1]].lower()), "patterns": patterns(t, s[0], s[1])}
                base.append([row_of(s) for s in own])
                more.append([row_of(s) for s in instances(t, own)])
            given = [pa.array(range(row, row + n), pa.int64()), batch.column("doc_id").slice(piece.lo, n), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums)]
            row += n
            yield pa.RecordBatch.from_arrays([*given, pa.array(base, _SPAN_TYPE), pa.array(more, _SPAN_TYPE)], names=["row", "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "more"])


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: a row number, counts and digest of base spans, base spans and instances with their patterns; stored."""
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shape = f"row long, doc_id {src.schema['doc_id'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, base array<{_SPAN}>, more array<{_SPAN}>"
    path = scratch_path(docs.sparkSession, "pii")
    src.mapInArrow(_scan, shape).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def graph(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different (pattern, inst, kind) of the seeds, and different (pattern, inst, kinds as bits) of the others; stored."""
    spark = scanned.sparkSession
    out = []
    for side in ("base", "more"):
        path = scratch_path(spark, "graph")
        spans = scanned.select(F.explode(side).alias("s")).select("s.kind", "s.inst", F.explode("s.patterns").alias("pattern"))
        spans.groupBy("pattern", "inst", "kind").agg(F.lit(1).alias("one")).drop("one").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out[0], out[1]


def salted(many: DataFrame, few: DataFrame, on: str, by: str) -> DataFrame:
    """Join of ``many`` rows of a value of ``on`` with the few of ``few``; the rows of a hot value are dealt out by ``by``."""
    salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS)))).alias("salt")
    return many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(few.select("*", salts), [on, "salt"]).drop("salt")


def bootstrap(seeds: DataFrame, others: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """inst, kind, score of the unseen instances that the last round's patterns know."""
    known = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    kept = known.filter(F.col("seeds") >= least_seeds)  # patterns of fewer seeds never count
    unseen = others.join(kept.select("pattern").distinct(), "pattern", "left_semi")
    is_made_like = lambda k: F.expr(f"(kind & {1 << k}) > 0").cast("long")
    beside = unseen.groupBy("pattern").agg(F.count("*").alias("unseen"), F.array(*(F.sum(is_made_like(k)) for k in range(len(KINDS)))).alias("alike"))
    kept = kept.join(seeds.groupBy("pattern").agg(F.count("*").alias("all_seeds")), "pattern").join(beside, "pattern")
    open_kind = F.element_at("alike", F.col("kind") + 1) * (1 - UNKNOWN)
    kept = cut(kept.select("pattern", "kind", "seeds", (F.col("all_seeds") + F.col("unseen") - open_kind).alias("n")))
    found = None
    for _ in range(rounds):
        scored = kept.withColumn("more", F.lit(0.0)).withColumn("grown", F.lit(0))
        if found is not None:
            grown = salted(unseen.select("pattern", "inst").distinct(), found, "inst", "pattern").groupBy("pattern", "kind").agg(F.sum("score").alias("more"), F.count("*").alias("grown"))
            scored = kept.join(grown, ["pattern", "kind"], "left").fillna(0, ["more", "grown"])
        scored = scored.select("pattern", "kind", ((F.col("seeds") + F.col("more")) / (F.col("n") + (1 - UNKNOWN) * F.col("grown") + DOUBT)).alias("score")).filter(F.col("score") >= least_score)
        edges = salted(unseen.withColumnRenamed("kind", "bits"), scored, "pattern", "inst").filter(F.expr("(bits & shiftleft(1, kind)) > 0"))
        best = edges.groupBy("inst", "kind").agg(F.max("score").alias("score")).groupBy("inst").agg(F.max(F.struct("score", (-F.col("kind")).alias("least"))).alias("b"))
        found = cut(best.select("inst", (-F.col("b.least")).alias("kind"), F.col("b.score").alias("score")))
    return found


def find(docs: DataFrame, **settings: float) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of base kinds, base_sha256, spans, n_added."""
    scanned = scan(docs)
    seeds, others = graph(scanned)
    found = bootstrap(seeds, others, **settings)
    places = scanned.select("row", F.explode("more").alias("s")).select("row", "s.start", "s.end", "s.inst")
    hits = salted(places, found, "inst", "row").groupBy("row").agg(F.collect_list(F.struct("start", F.lit(0).alias("b"), F.col("kind"), "end")).alias("added"))
    rank = lambda kind, of: F.element_at(F.array(*(F.lit(k) for k in of)), kind + 1)
    line = lambda s: F.concat_ws(":", F.when(s["b"] == 1, rank(s["kind"], KINDS)).otherwise(rank(s["kind"], ADDED)), s["start"], s["end"])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("b"), s["kind"].alias("kind"), s["end"].alias("end")))
    # by start, then base kinds before added ones, as listed
    both = F.array_sort(F.transform(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,b:int,kind:int,end:int>>"))), lambda s: F.struct(s["start"].alias("start"), (1 - s["b"]).alias("late"), s["kind"].alias("kind"), s["end"].alias("end"), s["b"].alias("b"))))
    return (
        scanned.drop("more")
        .join(hits, "row", "left")
        .select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", F.array_join(F.transform(both, line), ",").alias("spans"), F.when(F.col("added").isNull(), 0).otherwise(F.size("added")).cast("long").alias("n_added"))
    )
