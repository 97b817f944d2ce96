"""Vectorised scans of text columns inside tasks: words, lines and windows of whole Arrow batches as numpy arrays.

A batch is cut into slices of a few MB of whole texts, so the memory of a task
is bounded by the slice or by the longest single text. Words are told apart by
64-bit polynomial hashes over randomly drawn byte values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
ASCII_SPACE = bytes([9, 10, 11, 12, 13, 32])

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_LEN = np.uint64(0xC2B2AE3D27D4EB4F)
_LANES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Slice(NamedTuple):
    """Rows ``lo`` to ``hi`` of a batch: their UTF-8 bytes and each text's bounds in them."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray


class Words(NamedTuple):
    """Byte bounds of each word, the row it stands in, and its hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return table(_P), table(_P_INV)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(16, (n - 1).bit_length()))


def slices(texts: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of whole texts; null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield Slice(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set flags between each text's bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def edges(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of set flags; no run reaches over a text's bound."""
    n = len(inside)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        inner = off[(off > 0) & (off < n)]
        before[inner] = False
        after[inner - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums, one more than there are bytes."""
    out = np.zeros(len(codes) + 1, np.uint64)
    if len(codes):
        np.cumsum(_BYTE[codes] * powers(len(codes))[0][: len(codes)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span, equal for equal bytes wherever they stand."""
    if not len(start):
        return np.empty(0, np.uint64)
    inv = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64) * _LEN)


def words(piece: Slice, lut: np.ndarray) -> Words:
    """Runs of bytes whose ``lut`` value is not 0; hashes are over the ``lut`` values."""
    codes = lut[piece.buf]
    start, end = edges(codes != 0, piece.off)
    doc = np.searchsorted(piece.off, start, "right") - 1
    return Words(start, end, doc, span_hashes(prefix_hashes(codes), start, end))


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``k`` words from each word on, and whether they all stand in one text."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += w.hash[j : j + n] * _LANES[j % len(_LANES)]
    return mix(out), w.doc[:n] == w.doc[k - 1 :]


def not_space_lut(fold_case: bool) -> np.ndarray:
    """Words are runs of anything but ASCII white space; A-Z count as a-z if ``fold_case``."""
    lut = np.arange(256, dtype=np.uint8)
    lut[0] = 255  # never part of UTF-8, so NUL stays a letter of its own
    lut[list(ASCII_SPACE)] = 0
    if fold_case:
        lut[65:91] += 32
    return lut


def alnum_lut() -> np.ndarray:
    """Words are runs of 0-9, a-z in either case, and all beyond ASCII."""
    lut = np.arange(256, dtype=np.uint8)
    lut[:48] = 0
    lut[58:65] = 0
    lut[91:97] = 0
    lut[123:128] = 0
    lut[65:91] += 32
    return lut
