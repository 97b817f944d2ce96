"""Token ids of whole texts by the tokenizers library, each distinct chunk of text tokenized once per worker.

A text is cut where the tokenizer's own pre-tokenization always cuts, so that a
chunk's ids do not depend on what stands around it: before single white space
that a visible character follows (byte-level vocabularies keep it with the next
word), at white space (word vocabularies drop it), and between a letter and
ASCII punctuation other than an apostrophe. Chunks are looked up by hash in a
table that a worker keeps over its tasks. Texts that may hold special tokens
are tokenized whole.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np

from leadspark.llm import textscan as ts

#: Entries of a worker's table of chunks; it starts anew beyond them (about 25 bytes each).
MAX_CHUNKS = 1_500_000

_SPACE, _UNSURE, _LETTER, _PUNCT = 1, 2, 4, 8
# unsure: lead bytes of the blocks with further white space; the character after a boundary must be visible for certain
_CLASS = bytes(
    _SPACE * (c in ts.ASCII_SPACE)
    | _UNSURE * (c in (0xC2, 0xE1, 0xE2, 0xE3))
    | _LETTER * (65 <= c <= 90 or 97 <= c <= 122)
    | _PUNCT * (33 <= c < 127 and not chr(c).isalnum() and chr(c) != "'")
    for c in range(256)
)
_RAW = ts.not_space_lut(fold_case=False)


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The visible letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Chunks:
    """Ids of chunks by hash: a table of at least twice as many places as chunks, searched from the place that a hash names on."""

    def __init__(self) -> None:
        self.ids = np.empty(1 << 16, np.uint16)
        self.used = 0
        self.size = 0
        self.keys, self.at, self.length = np.empty(1 << 12, np.uint64), np.empty(1 << 12, np.int32), np.empty(1 << 12, np.int32)
        self.table = np.full(1 << 13, -1, np.int32)

    def __len__(self) -> int:
        return self.size

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.table) - 1)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key's chunk; -1 where unknown."""
        home = self._home(keys)
        out = self.table[home]
        off = np.flatnonzero((self.keys[out] != keys) & (out >= 0))
        step = 0
        while len(off):
            step += 1
            out[off] = self.table[(home[off] + step) & (len(self.table) - 1)]
            off = off[(self.keys[out[off]] != keys[off]) & (out[off] >= 0)]
        return out

    def _place(self, first: int) -> None:
        """Enters the chunks from number ``first`` on."""
        home, left = self._home(self.keys[first : self.size]), np.arange(first, self.size, dtype=np.int32)
        while len(left):
            free = self.table[home] < 0
            self.table[home[free]] = left[free]
            lost = self.table[home] != left
            home, left = (home[lost] + 1) & (len(self.table) - 1), left[lost]

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        """Takes in distinct chunks that are not known yet."""
        length = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.uint16)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids), np.uint16)])
        self.ids[self.used : self.used + len(flat)] = flat
        first, self.size = self.size, self.size + len(keys)
        while self.size > len(self.keys):
            self.keys, self.at, self.length = (np.concatenate([x, np.empty(len(x), x.dtype)]) for x in (self.keys, self.at, self.length))
        self.keys[first : self.size] = keys
        self.at[first : self.size] = self.used + np.cumsum(length) - length
        self.length[first : self.size] = length
        self.used += len(flat)
        if 2 * len(self.keys) > len(self.table):
            self.table, first = np.full(2 * len(self.keys), -1, np.int32), 0
        self._place(first)


class Encoder:
    """Ids of the texts of a slice. ``spaced``: white space belongs to the next word."""

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = spaced
        self.letters = {b: c for b, c in _byte_letters().items()}
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = Chunks()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def chunk(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if self.spaced:
            word = text[1:] if text[0] == " " else text
            if word.isalpha() and word.isascii():  # letters stand for themselves, the space is the only other byte
                return [t.id for t in self.model.tokenize(text if word is text else self.letters[32] + word)]
        else:
            text = word = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
        if word.isalpha():  # one pre-token: straight to the model
            return [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]
        return self.whole(raw.decode())

    def bounds(self, piece: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each chunk."""
        buf, n = piece.buf, len(piece.buf)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cut = np.zeros(n, bool)
        kind = np.frombuffer(buf.tobytes().translate(_CLASS), np.uint8)
        punct = kind == _PUNCT
        cut[1:] = (kind[:-1] == _LETTER) & punct[1:]
        if n > 2:  # two-byte letters of the Latin-1 block, all but the signs for times and division
            latin = (buf[:-2] == 0xC3) & (buf[1:-1] != 0x97) & (buf[1:-1] != 0xB7)
            cut[2:] |= latin & punct[2:]
        space = kind == _SPACE
        if self.spaced:
            cut[:-1] |= space[:-1] & (kind[1:] & (_SPACE | _UNSURE) == 0)
            cut[piece.off[:-1][piece.off[:-1] < n]] = True
            start = np.flatnonzero(cut)
            return start, np.append(start[1:], n)
        inside = ~space
        start, end = ts.edges(inside, piece.off)
        more = np.flatnonzero(cut & inside)
        start = np.unique(np.concatenate([start, more]))
        nearest = np.append(start[1:], n)
        return start, np.minimum(nearest, end[np.searchsorted(end, start, "right")])

    def encode(self, piece: ts.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's texts one after the other, and how many each text has."""
        raw, texts = piece.buf.tobytes(), piece.hi - piece.lo
        start, end = self.bounds(piece)
        doc = np.searchsorted(piece.off, start, "right") - 1
        odd = {d: self.whole(raw[piece.off[d] : piece.off[d + 1]].decode()) for d in self._with_special(raw, piece.off)}
        if odd:
            keep = ~np.isin(doc, list(odd))
            start, end, doc = start[keep], end[keep], doc[keep]
        keys = ts.span_hashes(ts.prefix_hashes(piece.buf), start, end)
        if len(self.chunks) > MAX_CHUNKS:
            self.chunks = Chunks()
        which = self.chunks.find(keys)
        new = np.flatnonzero(which < 0)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            self.chunks.add(fresh, [self.chunk(raw[start[i] : end[i]]) for i in new[first]])
            which[new] = self.chunks.find(keys[new])
        size = self.chunks.length[which].astype(np.int64)
        total = int(size.sum())
        ids = self.chunks.ids[np.repeat(self.chunks.at[which] - (np.cumsum(size) - size), size) + np.arange(total)]
        count = np.bincount(doc, weights=size, minlength=texts).astype(np.int64)
        if not odd:
            return ids, count
        ends = np.cumsum(count)
        parts = [np.array(odd[d], np.uint16) if d in odd else ids[ends[d] - count[d] : ends[d]] for d in range(texts)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _with_special(self, raw: bytes, off: np.ndarray) -> list[int]:
        found = set()
        for mark in self.special:
            at = raw.find(mark)
            while at >= 0:
                found.add(int(np.searchsorted(off, at, "right")) - 1)
                at = raw.find(mark, at + 1)
        return sorted(found)


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder a worker and vocabulary, kept over tasks."""
    return Encoder(path, spaced)


def with_end(ids: np.ndarray, count: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end`` after each text's."""
    full = count + 1
    out = np.full(int(full.sum()), end, np.uint16)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(full) - 1] = False
    out[keep] = ids
    return out, full


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
