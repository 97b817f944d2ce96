"""Secret scans by grammar inference.

Base scanners find assigned, access-key and hexadecimal credentials by their
fixed patterns. The credentials they find are the labelled ones: a bounded
sample of each kind, least hashes first, becomes a prefix tree of symbols whose
statistically compatible states are merged (red and blue states, Hoeffding
bound) into a probabilistic automaton. Every further candidate in the corpus -
a run of credential characters with letters and digits, and what is left of it
outside base spans - is then scored by its
likelihood under each automaton twice: against random characters, per symbol,
and against words (runs of letters and digits of word length that seldom change
between cases and digits), in total. Mixed-case formats look like random
characters in themselves, so only the second can tell them apart. Candidates
whose format is likely enough by either add spans of the kind ``format``. Base
spans always stay.

Texts are read once: the scan stores base spans and candidates, and training
and scoring work on those.

Edge cases: a null or empty text has no spans; repeated rows are scanned each;
without any labelled credential no candidate is flagged; an empty table gives
no rows; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.llm import textscan as ts
from leadspark.session import scratch_path

#: Fixed patterns of the base scanners.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "format")

#: Candidates: runs of credential characters of at least this length, with a letter and a digit.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
LEAST_CANDIDATE = 16
#: Most labelled credentials of a kind that an automaton is trained from.
SAMPLE = 4_000
#: Longer credentials do not train an automaton.
LONGEST = 256
ALPHA = 0.01
#: Least log-likelihood ratio per symbol of a flagged candidate, against random symbols.
LEAST_GAIN = 0.5
#: A total log-likelihood ratio of this much against words counts as one per symbol against random symbols.
TOTAL = 10.0
REDACTED = "[secret]"


_RUN = re.compile(r"[A-Za-z0-9]+")
_TAG = re.compile(r"[A-Z]{4}(?=[A-Z0-9])")


def symbols(word: str) -> str:
    """One symbol a character: what its run of letters and digits is made of.

    ``h`` lower-case hexadecimal, ``x`` lower case and digits, ``X`` upper case
    and digits, ``m`` mixed case; four capitals a word begins with and all
    other characters stand for themselves. Runs keep their length.
    """
    tag = m[0] if (m := _TAG.match(word)) else ""
    return tag + _RUN.sub(lambda m: _made_of(m[0]) * len(m[0]), word[len(tag) :])


def _made_of(run: str) -> str:
    if not run.strip("0123456789abcdef"):
        return "h"
    return "x" if run.islower() else "X" if run.isupper() else "m"


@dataclass
class State:
    count: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    n: dict[str, int] = field(default_factory=dict)


class Automaton:
    """Probabilistic automaton from samples, by merging states of their prefix tree."""

    def __init__(self, samples: list[str], alpha: float = ALPHA):
        self.states = [State()]
        for s in samples:
            at = 0
            self.states[0].count += 1
            for c in s:
                own = self.states[at]
                own.n[c] = own.n.get(c, 0) + 1
                if c not in own.to:
                    own.to[c] = len(self.states)
                    self.states.append(State())
                at = own.to[c]
                self.states[at].count += 1
            self.states[at].ends += 1
        self.confidence = math.sqrt(0.5 * math.log(2 / alpha))
        self.alphabet = len({c for s in samples for c in s}) or 1
        self._merge_all()

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > self.confidence * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = (self.states[i] for i in todo.pop())
            if not x.count or not y.count:
                continue
            if self._differ(x.ends, x.count, y.ends, y.count):
                return False
            for c in x.n.keys() | y.n.keys():
                if self._differ(x.n.get(c, 0), x.count, y.n.get(c, 0), y.count):
                    return False
                if c in x.to and c in y.to:
                    todo.append((x.to[c], y.to[c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            i, j = todo.pop()
            x, y = self.states[i], self.states[j]
            x.count += y.count
            x.ends += y.ends
            for c, k in y.to.items():
                x.n[c] = x.n.get(c, 0) + y.n[c]
                if c in x.to:
                    todo.append((x.to[c], k))
                else:
                    x.to[c] = k

    def _merge_all(self) -> None:
        red, seen = [0], {0}
        while True:
            blue = sorted({(i, c) for i in red for c, k in self.states[i].to.items() if k not in seen}, key=lambda e: (-self.states[self.states[e[0]].to[e[1]]].count, e))
            if not blue:
                break
            i, c = blue[0]
            k = self.states[i].to[c]
            for r in red:
                if self._compatible(r, k):
                    self.states[i].to[c] = r
                    self._fold(r, k)
                    break
            else:
                red.append(k)
                seen.add(k)
        self.size = len(red)

    def log_likelihood(self, s: str) -> float:
        """Natural log of the probability of ``s``; what was never seen gets the weight of half a sample."""
        at, total = 0, 0.0
        for c in s:
            own = self.states[at]
            total += math.log((own.n.get(c, 0) + 0.5 / (self.alphabet + 1)) / (own.count + 0.5))
            if c not in own.to:
                return -math.inf
            at = own.to[c]
        own = self.states[at]
        return total + math.log((own.ends + 0.5 / (self.alphabet + 1)) / (own.count + 0.5))


#: Share of the 67 credential characters that each symbol stands for.
_NOISE = {"h": 16 / 67, "x": 36 / 67, "X": 36 / 67, "m": 62 / 67}


#: Words as noise: all kinds of runs alike, one of the six other characters between runs; a run ends at each symbol with this probability.
_RUN_ENDS = 1 / 6
_KINDS_OF_RUNS, _OTHERS, _CAPITALS = 4, 6, 26
#: Lower case, upper case and digits: their shares in a random run of each kind, and how a word goes on after each of them.
_RANDOM = {"h": (6 / 16, 0, 10 / 16), "x": (26 / 36, 0, 10 / 36), "X": (0, 26 / 36, 10 / 36), "m": (26 / 62, 26 / 62, 10 / 62)}
_WORDS = {k: ((0.95, 0.95, 0.05), (0.95, 0.95, 0.05), (0.3, 0.3, 0.7)) for k in "hxX"} | {"m": ((0.83, 0.12, 0.05), (0.9, 0.07, 0.03), (0.2, 0.2, 0.6))}
_CHANGES = {k: [[math.log(p / q) if p else 0.0 for p, q in zip(_RANDOM[k], row)] for row in _WORDS[k]] for k in _WORDS}
_SAME = re.compile(r"([hxXm])\1*|.", re.S)


def _word_noise(s: str) -> float:
    """Log-likelihood of a format among words."""
    total = 0.0
    for m in _SAME.finditer(s):
        if m[1]:
            total += (len(m[0]) - 1) * math.log(1 - _RUN_ENDS) + math.log(_RUN_ENDS / _KINDS_OF_RUNS)
        else:
            total -= math.log(_CAPITALS if m[0].isalpha() else _OTHERS)
    return total


def changes(word: str) -> float:
    """Log-likelihood ratio of how cases and digits follow each other in the word's runs: random against words."""
    at = m.end() if (m := _TAG.match(word)) else 0
    total = 0.0
    for m in _RUN.finditer(word, at):
        table = _CHANGES[_made_of(m[0])]
        sort = [2 if c.isdigit() else c.isupper() for c in m[0]]
        total += sum(table[a][b] for a, b in zip(sort, sort[1:]))
    return total


def _format_gains(automata: list[Automaton], s: str) -> tuple[float, float]:
    """Best log-likelihood ratios of a format: per symbol against random characters, in total against words."""
    noise = sum(math.log(_NOISE.get(c, 1 / 67)) for c in s)
    best = max((a.log_likelihood(s) for a in automata), default=-math.inf)
    return (best - noise) / len(s), best - _word_noise(s)


def gain(automata: list[Automaton], word: str) -> float:
    """Best log-likelihood ratio of the word's format, per symbol against random characters or in total against words."""
    each, total = _format_gains(automata, symbols(word))
    return max(each, (total + changes(word)) / TOTAL)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, secret) of the base scanners, by start, then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k], w) for a, b, k, w in sorted(out)]


def _is_candidate(word: str) -> bool:
    return len(word) >= LEAST_CANDIDATE and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, word) of runs of credential characters with a letter and a digit."""
    out = []
    for m in CANDIDATE.finditer(text):
        word = m[0].rstrip(".=-_/+") if m[0][-1] == "." else m[0]
        if _is_candidate(word):
            out.append((m.start(), m.start() + len(word), word))
    return out


def with_parts(text: str, found: list[tuple[int, int, str]], base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """Candidates by start: those not inside base spans, and the parts of those outside base spans, without the character that joins them."""
    out, spans, first = [], [], 0
    for a, b, *_ in base:
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    for a, b, word in found:
        while first < len(spans) and spans[first][1] <= a:
            first += 1
        cut, k = [], first
        while k < len(spans) and spans[k][0] < b:
            cut.append(spans[k])
            k += 1
        if not cut:
            out.append((a, b, word))
            continue
        if cut[0][0] <= a and b <= cut[0][1]:
            continue
        out.append((a, b, word))
        starts, ends = [a, *(q for _, q in cut)], [*(p for p, _ in cut), b]
        for i, (p, q) in enumerate(zip(starts, ends)):
            p += i > 0 and p < q and not text[p].isalnum()
            q -= i < len(cut) and p < q and not text[q - 1].isalnum()
            if _is_candidate(text[p:q]):
                out.append((p, q, text[p:q]))
    return out


_SPAN = "struct<start:int,end:int,kind:string,word:string>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("word", pa.string())]))


def _find(texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
    base, more = [], []
    for t in texts:
        own = base_spans(t) if t else []
        base.append([dict(zip(("start", "end", "kind", "word"), x)) for x in own])
        more.append([{"start": a, "end": b, "kind": "format", "word": w} for a, b, w in (with_parts(t, candidates(t), own) if t else [])])
    return pa.array(base, _SPAN_TYPE), pa.array(more, _SPAN_TYPE)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in ts.slices(batch.column("text")):
            part = batch.slice(piece.lo, piece.hi - piece.lo)
            base, more = _find(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), base, more], names=["doc_id", "base", "more"])


def train(found: DataFrame, sample: int = SAMPLE) -> list[Automaton]:
    """An automaton per kind from at most ``sample`` distinct labelled credentials each, least hashes first."""
    labelled = found.select(F.explode("base").alias("s")).select("s.kind", "s.word").filter(F.length("word") <= LONGEST).distinct()
    out = []
    for kind in KINDS[:3]:
        words = labelled.filter(F.col("kind") == kind).orderBy(F.xxhash64("word"), "word").limit(sample).collect()
        if words:
            out.append(Automaton([symbols(r["word"]) for r in words]))
    return out


def _chosen(automata: list[Automaton], more: list[list[dict]], least_gain: float) -> list[list[dict]]:
    known: dict[str, tuple[float, float]] = {}

    def flagged(word: str) -> bool:
        form = symbols(word)
        if form not in known:
            known[form] = _format_gains(automata, form)
        each, total = known[form]
        return each >= least_gain or total > -math.inf and (total + changes(word)) / TOTAL >= least_gain

    return [[x for x in own if flagged(x["word"])] for own in more]


def find(docs: DataFrame, sample: int = SAMPLE, least_gain: float = LEAST_GAIN) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of base kinds, base_sha256, spans, and the spans that the method added."""
    spark = docs.sparkSession
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, "secrets")
    src.mapInArrow(_scan, f"doc_id {kind}, base array<{_SPAN}>, more array<{_SPAN}>").write.parquet(path)
    found = spark.read.parquet(path)
    automata = spark.sparkContext.broadcast(train(found, sample))  # bounded by the samples

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = batch.column("base").to_pylist(), batch.column("more").to_pylist()
            more = _chosen(automata.value, more, least_gain)
            line = lambda xs: ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in xs)
            spans = [line(sorted([*b, *m], key=lambda x: (x["start"], KINDS.index(x["kind"])))) for b, m in zip(base, more)]
            count = lambda k: pa.array([sum(x["kind"] == k for x in b) for b in base], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(count, KINDS[:3]), pa.array([hashlib.sha256(line(b).encode()).hexdigest() for b in base], pa.string()), pa.array(spans, pa.string()), pa.array([len(m) for m in more], pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"],
            )

    return found.mapInArrow(score, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")


def redacted(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with overlapping spans joined and each replaced by a mark."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], REDACTED]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, sample: int = SAMPLE, least_gain: float = LEAST_GAIN, n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with all columns; secrets in ``text`` are replaced by a mark, and ``n_chars``, if there is such a column, follows."""
    spark = docs.sparkSession
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    path = scratch_path(spark, "secrets")
    src.mapInArrow(_scan, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, base array<{_SPAN}>, more array<{_SPAN}>").select("base").filter(F.size("base") > 0).write.parquet(path)
    automata = spark.sparkContext.broadcast(train(spark.read.parquet(path), sample))
    at = docs.columns.index("text")
    count = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in ts.slices(batch.column(at)):
                part = batch.slice(piece.lo, piece.hi - piece.lo)
                old = part.column(at).to_pylist()
                base, more = (c.to_pylist() for c in _find(old))
                more = _chosen(automata.value, more, least_gain)
                new = [redacted(t, [(x["start"], x["end"]) for x in [*b, *m]]) if b or m else t for t, b, m in zip(old, base, more)]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.schema.field(at).type)
                if count is not None:
                    was = cols[count].to_pylist()
                    cols[count] = pa.array([c if t is s else len(s) for t, s, c in zip(old, new, was)], part.schema.field(count).type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(cut, docs.schema)


def held_out_accuracy(automata: list[Automaton], secrets: list[str], others: list[str], least_gain: float = LEAST_GAIN) -> float:
    """Mean of the shares of secrets flagged and of other words left alone."""
    share = lambda words: float(np.mean([gain(automata, w) >= least_gain for w in words]))
    return (share(secrets) + 1 - share(others)) / 2
