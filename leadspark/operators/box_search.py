"""Exact nearest rows among narrow vectors, by boxes around neighbouring rows.

Indexed rows lie in boxes of few rows, cut at medians of the widest column, and
queries are taken in groups of neighbours. A group meets the boxes nearest first
and ends at the first box that lies beyond the k-th distance of all its queries.
"""

from __future__ import annotations

import numpy as np

#: Wider vectors are not helped by boxes: nearly all of them are met.
NARROW = 7
BOX_ROWS = 64
GROUP_ROWS = 128
#: Rows of the boxes that a group meets at a time, at first and later.
FIRST_ROWS, STEP_ROWS = 512, 2048


def copies_kept(x: np.ndarray, ids: np.ndarray, copies: int) -> np.ndarray:
    """Row numbers, of equal rows those of the ``copies`` lowest ids: ties go to the lower id, so the others are never among so many nearest."""
    order = np.lexsort((ids, *x.T[::-1]))
    head = np.append(True, (x[order[1:]] != x[order[:-1]]).any(axis=1))[: len(x)]
    place = np.arange(len(x))
    return order[place - np.maximum.accumulate(np.where(head, place, 0)) < copies]


def few_copies(x: np.ndarray, ids: np.ndarray, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Finite rows, of equal ones those of the ``copies`` lowest ids."""
    finite = np.isfinite(x).all(axis=1)
    x, ids = x[finite], ids[finite]
    keep = copies_kept(x, ids, copies)
    return x[keep], ids[keep]


def halves(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers in sets of at most ``most`` neighbours."""
    out, todo = [], [np.arange(len(x))] if len(x) else []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        part = x[rows]
        values = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))]
        half = len(rows) // 2
        order = np.argpartition(values, half)
        todo += [rows[order[half:]], rows[order[:half]]]
    return out


def _root(gaps) -> np.ndarray:
    """Square root of the sum of squares of one array for each column."""
    total = None
    for g in gaps:
        total = g * g if total is None else total + g * g
    return np.sqrt(total)


class BoxIndex:
    """Rows of at least one column and their ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, box_rows: int = BOX_ROWS):
        boxes = halves(x, box_rows)
        order = np.concatenate(boxes) if boxes else np.empty(0, np.int64)
        self.x, self.ids = x[order], ids[order]
        self.end = np.cumsum([len(b) for b in boxes], dtype=np.int64)
        self.start = self.end - np.array([len(b) for b in boxes], np.int64)
        self.low = np.array([x[b].min(axis=0) for b in boxes]).reshape(len(boxes), x.shape[1])
        self.high = np.array([x[b].max(axis=0) for b in boxes]).reshape(len(boxes), x.shape[1])

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """k smallest distances and ids of each query, ties to the lower id, and how many distances it took; infinite where rows run out."""
        d, i, work = np.full((len(queries), k), np.inf), np.full((len(queries), k), np.iinfo(np.int64).max), 0
        finite = np.flatnonzero(np.isfinite(queries).all(axis=1))
        if len(self.ids) and k:
            distinct, which = np.unique(queries[finite], axis=0, return_inverse=True)
            found_d, found_i = np.empty((len(distinct), k)), np.empty((len(distinct), k), np.int64)
            for rows in halves(distinct, GROUP_ROWS):
                found_d[rows], found_i[rows], n = self._group(distinct[rows], k)
                work += n
            d[finite], i[finite] = found_d[which.reshape(-1)], found_i[which.reshape(-1)]
        return d, i, work

    def _group(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        width = range(q.shape[1])
        low, high = q.min(axis=0), q.max(axis=0)
        to_box = _root(np.maximum(0, np.maximum(self.low[:, c] - high[c], low[c] - self.high[:, c])) for c in width)
        middle = _root((self.low[:, c] + self.high[:, c]) / 2 - (low[c] + high[c]) / 2 for c in width)
        order = np.lexsort((middle, to_box))
        rows_until = np.cumsum((self.end - self.start)[order])
        best_d, best_i = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        at, work = 0, 0
        while at < len(order):
            kth = best_d[:, -1]
            if to_box[order[at]] > kth.max():
                break
            stop = max(at + 1, int(np.searchsorted(rows_until, (rows_until[at - 1] if at else 0) + (STEP_ROWS if at else FIRST_ROWS), "right")))
            box = order[at:stop]
            meets = _root(np.maximum(0, np.maximum(self.low[box, c] - q[:, c, None], q[:, c, None] - self.high[box, c])) for c in width) <= kth[:, None]
            at = stop
            live, box = np.flatnonzero(meets.any(axis=1)), box[meets.any(axis=0)]
            if not len(live):
                continue
            spot = np.concatenate([np.arange(a, b) for a, b in zip(self.start[box], self.end[box])])
            x, own = self.x[spot], q[live]
            d = np.concatenate([best_d[live], _root(own[:, c, None] - x[:, c] for c in width)], axis=1)
            work += len(live) * len(spot)
            row, col = np.nonzero(d <= np.partition(d, k - 1, axis=1)[:, k - 1, None])
            dist, ids = d[row, col], np.concatenate([best_i[live], np.broadcast_to(self.ids[spot], (len(live), len(spot)))], axis=1)[row, col]
            by = np.lexsort((ids, dist, row))
            rank = np.arange(len(row)) - np.searchsorted(row, row)  # rows come in order
            top = rank < k
            best_d[live[row[top]], rank[top]], best_i[live[row[top]], rank[top]] = dist[by][top], ids[by][top]
        return best_d, best_i, work


def without_own(d: np.ndarray, i: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of each row's neighbours that are not the row itself."""
    hit = i == own[:, None]
    order = np.argsort(hit, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(np.where(hit, np.inf, d), order, axis=1), np.take_along_axis(i, order, axis=1)
