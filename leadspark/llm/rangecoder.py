"""Adaptive context-mixing range coder for token ids, many blocks in step on numpy arrays.

Each block starts from nothing. For the next id, order 2 and order 1 predict
the id that followed their context last, and order 0 predicts the ids seen so
far by their counts; a uniform part covers the rest. Each prediction holds a
part of the coder's range in proportion to its weight: for orders 1 and 2 the
adaptive odds of being right, kept apart by how often in a row the context was
right before. Where both name one id their parts are mixed into one. An id
takes the part of the highest order that names it.

The order-0 counts are taken again whenever a block has grown by a fifth, at
the same places in coder and decoder. The coder is carry-less, with 64-bit
state and 32-bit words. Weights are double-precision numbers, changed by the
same elementary operations in coder and decoder.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 2048
#: Bits of weight of an id's count against one part of the uniform share.
COUNT_BITS = 5
SLOT_BITS = (9, 10)
RATE = 1 / 20
MOST = 0.985
NONE = 0xFFFF
_EMPTY = 4  # the streak of a context that was not met yet; its odds are and stay 0
_WORD = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_ONE = np.uint64(1)


def _renewals(n: int) -> set[int]:
    """Where the order-0 counts are taken again."""
    out, at = set(), 16
    while at < n:
        out.add(at)
        at += max(16, at // 5)
    return out


_NEXT = np.array([1, 2, 3, 3, 1, 1, 1, 1], np.int32)  # streak after a hit


class _Model:
    """Predictions of all blocks (lanes) that are coded in step; arrays of two rows are orders 1 and 2."""

    def __init__(self, lanes: int, length: int, vocabulary: int):
        self.vocabulary = vocabulary
        one, two = (1 << b for b in SLOT_BITS)
        lane = np.arange(lanes, dtype=np.int64)
        self.slots = np.full(lanes * (one + two), NONE | _EMPTY << 16, np.int32)
        self.base = np.stack([lane * (one + two), lane * (one + two) + one])
        self.chance = np.tile(np.array([0.3, 0.5, 0.6, 0.7, 0, 0, 0, 0]), 2 * lanes)
        self.odds = np.stack([lane * 8, (lane + lanes) * 8])
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.n = 0

    def predict(self, m: int) -> None:
        """Of the first ``m`` lanes: what orders 2 and 1 name, and each one's part of the range."""
        self.base_total = (self.n << COUNT_BITS) + self.vocabulary
        one = self.last[:m] * 40503
        two = (one + self.before[:m] * 30103) * 48271
        self.spot = self.base[:, :m].copy()
        self.spot[0] += (one >> (16 - SLOT_BITS[0])) & ((1 << SLOT_BITS[0]) - 1)
        self.spot[1] += (two >> 5) & ((1 << SLOT_BITS[1]) - 1)
        held = self.slots.take(self.spot)
        self.named = held & NONE
        self.streak = held >> 16
        self.kind = self.odds[:, :m] + self.streak
        self.p = self.chance.take(self.kind)
        part = (self.p / (1 - self.p) * self.base_total).astype(np.int32)  # below 66 * (2^5 * 2^16 + 2^16)
        self.one = part[0] * (self.named[0] != self.named[1])
        self.high = part[0] + part[1]
        self.two = self.high - self.one
        self.total = (self.high + self.base_total).astype(np.uint64)

    def update(self, m: int, ids: np.ndarray) -> None:
        """Learns ``ids``, for which :meth:`spans` was asked before."""
        p = self.hit - self.p
        p *= RATE
        p += self.p
        self.chance[self.kind] = np.minimum(p, MOST, out=p)
        streak = _NEXT.take(self.streak)
        streak *= self.hit
        streak <<= 16
        streak |= ids
        self.slots[self.spot] = streak
        self.before[:m], self.last[:m] = self.last[:m], ids

    def spans(self, ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the part of each id starts, and its width; ``first`` and ``count`` are its order-0 statistics."""
        self.hit = self.named == ids
        one, two = self.hit[0] & (self.one > 0), self.hit[1] & (self.two > 0)
        seen = count > 0
        start = self.high + np.where(seen, first << COUNT_BITS, (self.n << COUNT_BITS) + ids)
        width = np.where(seen, count << COUNT_BITS, 1)
        start = np.where(one, self.two, start) * ~two
        return start.astype(np.uint64), np.where(two, self.two, np.where(one, self.one, width)).astype(np.uint64)


class _Ahead:
    """Order-0 statistics for the coder, which has all ids at hand: places among the distinct ids of each block."""

    def __init__(self, table: np.ndarray, sizes: np.ndarray):
        length, lanes = table.shape
        # a stable sort of 16-bit numbers goes digit by digit; ids past a block's end sort last, as its own largest id again
        own = np.arange(length) < sizes[:, None]
        rows = np.ascontiguousarray(table.T)
        rows = np.where(own, rows, rows.max(axis=1, where=own, initial=0)[:, None]).astype(np.uint16)
        by_id = np.argsort(rows, axis=1, kind="stable")
        held = np.take_along_axis(rows, by_id, axis=1)
        new = np.ones((lanes, length), bool)
        new[:, 1:] = held[:, 1:] != held[:, :-1]
        self.place = np.empty((length, lanes), np.int32)
        self.place[by_id, np.arange(lanes)[:, None]] = np.cumsum(new.reshape(-1), dtype=np.int32).reshape(lanes, length) - 1
        self.heads = np.append(0, np.cumsum(new.sum(axis=1))[:-1])
        self.count = np.zeros(int(new.sum()), np.int64)
        self.both = self.count

    def renew(self, done: int, t: int, m: int) -> None:
        self.count += np.bincount(self.place[done:t, :m].reshape(-1), minlength=len(self.count))
        total = np.cumsum(self.count)
        before = total - self.count
        self.both = before - np.repeat(before[self.heads], np.diff(np.append(self.heads, len(before)))) | self.count << 32

    def seen(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and count of each id."""
        both = self.both.take(place)
        return both.astype(np.int32), (both >> 32).astype(np.int32)


class _Past:
    """Order-0 statistics for the decoder: sorted ids of the past, with the first place of each and its count."""

    def __init__(self, lanes: int, length: int):
        self.ids = np.zeros((lanes, length), np.uint16)
        self.stride = 0

    def renew(self, t: int, m: int) -> None:
        ids = np.sort(self.ids[:m, :t], axis=1, kind="stable")
        new = np.ones((m, t), bool)
        new[:, 1:] = ids[:, 1:] != ids[:, :-1]
        flat = np.flatnonzero(new.reshape(-1))
        count = np.diff(np.append(flat, m * t))
        self.packed = np.repeat(ids.reshape(-1)[flat] | flat % t << 16 | count << 32, count)
        self.row = np.arange(m, dtype=np.int64) * t


def _narrow(low, width, total, start, size, unit=None):
    """The coder's range after an id; where it gets small, whether its top word is settled now."""
    unit = width // total if unit is None else unit
    low = low + unit * start
    width = unit * size
    small = width <= _LOW
    # a small range over a word's bound is cut there, so that the top word never changes again
    at = np.flatnonzero(small)
    if len(at):
        lo = low[at]
        straddles = ((lo ^ (lo + width[at] - _ONE)) >> _WORD) != 0
        at, lo = at[straddles], lo[straddles]
        width[at] = (~lo & _LOW) + _ONE
    return low, width, small


def _batches(sizes: list[int]) -> list[list[int]]:
    """Numbers of blocks by falling size, dealt out evenly: a few over LANES make no batch of their own."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    many = max(1, round(len(order) / LANES))
    return [[order[i] for i in own] for own in np.array_split(np.arange(len(order)), many) if len(own)]


def encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """The coded words of each block, each on its own."""
    out: list[bytes] = [b""] * len(blocks)
    for own in _batches([len(b) for b in blocks]):
        for i, words in zip(own, _encode_lanes([blocks[i] for i in own], vocabulary)):
            out[i] = words
    return out


def _encode_lanes(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks])
    lanes, length = len(blocks), int(sizes.max())
    table = np.zeros((length, lanes), np.uint16)
    for i, b in enumerate(blocks):
        table[: len(b), i] = b
    model, ahead, renew = _Model(lanes, length, vocabulary), _Ahead(table, sizes), _renewals(length)
    words, filled = np.zeros((lanes, length + 2), np.uint32), np.zeros(lanes, np.int64)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0), np.uint64)
    for t in range(length):
        m = int(np.searchsorted(-sizes, -t, "left"))  # lanes are sorted, longest first
        if t in renew:
            ahead.renew(model.n, t, m)
            model.n = t
        ids = table[t, :m].astype(np.int32)
        model.predict(m)
        start, size = model.spans(ids, *ahead.seen(ahead.place[t, :m]))
        lo, wd, small = _narrow(low[:m], width[:m], model.total, start, size)
        out = np.flatnonzero(small)
        words[out, filled[out]] = lo[out] >> _WORD
        filled[out] += 1
        lo[out] <<= _WORD
        wd[out] <<= _WORD
        low[:m], width[:m] = lo, wd
        model.update(m, ids)
    rest = np.arange(lanes)
    words[rest, filled] = (low >> _WORD).astype(np.uint32)
    words[rest, filled + 1] = (low & _LOW).astype(np.uint32)
    return [words[i, : filled[i] + 2].astype("<u4").tobytes() for i in range(lanes)]


def decode(coded: list[bytes], sizes: list[int], vocabulary: int) -> list[np.ndarray]:
    out: list[np.ndarray] = [np.empty(0, np.uint16)] * len(coded)
    for own in _batches(sizes):
        for i, ids in zip(own, _decode_lanes([coded[i] for i in own], np.array([sizes[i] for i in own]), vocabulary)):
            out[i] = ids
    return out


def _decode_lanes(coded: list[bytes], sizes: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    lanes, length = len(coded), int(sizes.max())
    model, past, renew = _Model(lanes, length, vocabulary), _Past(lanes, length), _renewals(length)
    flat = np.frombuffer(b"".join(coded) + bytes(8), "<u4").astype(np.uint64)
    many = np.array([len(c) // 4 for c in coded])
    begin = np.cumsum(many) - many
    code = flat[begin] << _WORD | flat[begin + 1]
    read = begin + 2
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0), np.uint64)
    for t in range(length):
        m = int(np.searchsorted(-sizes, -t, "left"))
        if t in renew:
            past.renew(t, m)
            model.n = t
        model.predict(m)
        total = model.total
        unit = width[:m] // total
        value = np.minimum((code[:m] - low[:m]) // unit, total - _ONE).astype(np.int32)
        rest = value - model.high
        uniform = model.n << COUNT_BITS
        if model.n:
            seen = (rest >= 0) & (rest < uniform)
            found = past.packed.take(past.row[:m] + (rest >> COUNT_BITS) * seen)
            ids = np.where(seen, (found & NONE).astype(np.int32), rest - uniform)
            first, count = ((found >> 16) & NONE).astype(np.int32), (found >> 32).astype(np.int32) * seen
        else:
            ids, first, count = rest, rest, np.zeros(m, np.int32)
        ids = np.where(rest < 0, np.where(value < model.two, model.named[1], model.named[0]), ids)
        start, size = model.spans(ids, first, count)
        lo, wd, small = _narrow(low[:m], width[:m], total, start, size, unit)
        out = np.flatnonzero(small)
        code[out] = code[out] << _WORD | flat[np.minimum(read[out], len(flat) - 1)]
        read[out] += 1
        lo[out] <<= _WORD
        wd[out] <<= _WORD
        low[:m], width[:m] = lo, wd
        past.ids[:m, t] = ids
        model.update(m, ids)
    return [past.ids[i, :n] for i, n in enumerate(sizes)]


MAGIC = b"TKR1"


def pack(ids: np.ndarray, vocabulary: int, block: int = BLOCK) -> bytes:
    """Ids as bytes: magic, vocabulary, number of ids, block length; per block its bytes and the crc32 of its ids; the blocks."""
    blocks = [ids[i : i + block] for i in range(0, len(ids), block)]
    coded = encode(blocks, vocabulary)
    head = np.array([vocabulary, len(ids), block], "<u8")
    table = np.array([[len(c), zlib.crc32(b.astype("<u4").tobytes())] for b, c in zip(blocks, coded)], "<u4").reshape(-1, 2)
    return MAGIC + head.tobytes() + table.tobytes() + b"".join(coded)


def unpack(data: bytes) -> np.ndarray:
    """The ids that :func:`pack` wrote; raises if a block does not match its checksum."""
    if data[:4] != MAGIC:
        raise ValueError("not a token file")
    vocabulary, total, block = (int(x) for x in np.frombuffer(data, "<u8", 3, 4))
    blocks = -(-total // block)
    table = np.frombuffer(data, "<u4", 2 * blocks, 28).reshape(-1, 2)
    at = 28 + 8 * blocks
    ends = at + np.cumsum(table[:, 0].astype(np.int64))
    if len(data) != (ends[-1] if blocks else at):
        raise ValueError("token file is cut short")
    sizes = [min(block, total - i * block) for i in range(blocks)]
    out = decode([data[e - n : e] for e, n in zip(ends, table[:, 0].astype(np.int64))], sizes, vocabulary)
    for k, (ids, crc) in enumerate(zip(out, table[:, 1])):
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of block {k} does not match")
    return np.concatenate(out) if out else np.empty(0, np.uint16)
