"""FM-index over a sequence of symbols, with all queries of a kind answered at once on numpy arrays.

Symbol 0 separates runs and is never part of a phrase; every separator is a
symbol of its own when suffixes are sorted.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class FMIndex:
    def __init__(self, seq: np.ndarray, sigma: int):
        n = self.n = len(seq)
        self.sigma = sigma
        sa = suffix_array(seq)
        bwt = seq[sa - 1] if n else seq
        counts = np.bincount(seq, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # wavelet tree, level by level: ones before each place, and how many zeros a level has
        self.levels: list[tuple[int, int, np.ndarray]] = []
        at = bwt
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            one = (at >> bit) & 1
            ones = np.zeros(n + 1, np.int64)
            np.cumsum(one, out=ones[1:])
            self.levels.append((bit, n - int(ones[-1]), ones))
            at = np.concatenate([at[one == 0], at[one == 1]])
        # positions are kept for every SAMPLE-th symbol and at the start of each run, so that no walk crosses a separator
        kept = (sa % SAMPLE == 0) | (bwt == 0)
        self.rank_kept = np.zeros(n + 1, np.int64)
        np.cumsum(kept, out=self.rank_kept[1:])
        self.kept, self.position = kept, sa[kept]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each ``c`` stands before place ``i`` of the transformed sequence."""
        lo, hi = np.zeros_like(i), i
        for bit, zeros, ones in self.levels:
            one = ((c >> bit) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def step(self, i: np.ndarray) -> np.ndarray:
        """The row of the suffix that is longer by the symbol before it."""
        lo, at, c = np.zeros_like(i), i, np.zeros_like(i)
        for bit, zeros, ones in self.levels:
            one = (ones[at + 1] - ones[at]).astype(bool)
            a, b = ones[lo], ones[at]
            lo, at = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, at - b)
            c = c | (one.astype(np.int64) << bit)
        return self.first[c] + at - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose suffix begins with each phrase (a row of ``phrases``; 0 pads at the end)."""
        m = len(phrases)
        lo, hi = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        live = np.arange(m)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            on = np.flatnonzero(c > 0)
            rows, c = live[on], c[on]
            lo[rows] = self.first[c] + self.rank(c, lo[rows])
            hi[rows] = self.first[c] + self.rank(c, hi[rows])
            live = live[lo[live] < hi[live]]
        lo[lo > hi] = 0
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix: walk back to the next kept position."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            hit = self.kept[at]
            out[todo[hit]] = self.position[self.rank_kept[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                at = self.step(at)
            steps += 1
        return out


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Prefix doubling; only suffixes that still share their rank are sorted again."""
    n = len(seq)
    if not n:
        return np.empty(0, np.int64)
    gaps = np.flatnonzero(seq == 0)
    rank = seq.astype(np.int64) + len(gaps)
    rank[gaps] = np.arange(len(gaps))
    order = np.argsort(rank, kind="stable")
    rank = _ranks(rank[order], order, n)
    k = 1
    while True:
        ordered = rank[order]
        tied = np.zeros(n, bool)
        same = ordered[1:] == ordered[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        spots = np.flatnonzero(tied)
        if not len(spots):
            return order
        who = order[spots]
        ahead = np.where(who + k < n, rank[np.minimum(who + k, n - 1)] + 1, 0)
        again = np.lexsort((ahead, rank[who]))
        order[spots] = who[again]
        head, tail = rank[who][again], ahead[again]
        new = np.ones(len(spots), bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        rank[order[spots]] = spots[np.maximum.accumulate(np.where(new, np.arange(len(spots)), 0))]
        k *= 2


def _ranks(ordered: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Rank of each position: the place of the first one with an equal value."""
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(n, np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return out
