"""Exact nearest neighbours in a two-level metric index.

Indexed rows go to cells around drawn centres, about as many cells as the square
root of the rows, and cells to groups around some of the centres. Cells of one
group are put together to units of bounded size, and large cells are split into
parts. Units stand side by side on shelves; a shelf and some of the queries that
visit it are one task's work, as many of both as its memory bears whatever the
size of units, so that few copies of rows and queries are moved.

The search is best first. A query starts on the shelf of its nearest cell, which
gives it a distance that its k nearest rows do not exceed. Groups, then cells
that by the triangle inequality lie beyond it are never visited; on a visited
shelf the nearest cells come first, the distance shrinks as rows are found, and
of each cell only rows whose distance to the centre fits are compared. A cell
meets the queries that need it by one matrix product, which picks the pairs whose
distances are then taken exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadspark.functions.hashing import SPACE, hash32
from leadspark.operators.box_search import copies_kept
from leadspark.session import cut

#: Centres reach every task, so they hold at most this many numbers.
CENTRE_VALUES = 4_000_000
BLOCK_ROWS = 20_000
QUERY_ROWS = 50_000

#: Numbers of the indexed rows on a shelf, and of the queries that a task takes to it.
SHELF_VALUES, SHELF_ROWS = 2_560_000, 100_000
TRAY_VALUES, TRAY_ROWS = 1_280_000, 1_024
#: A query meets its nearest cells one by one: so many at first, then as long as few are left; products taken at a time.
FIRST_CELLS, FEW_CELLS = 2, 16
TILE, TILE_QUERIES = 500_000, 2_048

NEAR_SCHEMA = "_q long, distances array<double>, neighbour_ids array<long>"


def top_k(queries: np.ndarray, index: np.ndarray, ids: np.ndarray, own: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k smallest distances (and ids) per query row; ties go to the lower id."""
    k = min(k, len(ids))
    out_d, out_i = np.empty((len(queries), k)), np.empty((len(queries), k), dtype=np.int64)
    norms = (index * index).sum(axis=1)
    step = max(1, 4_000_000 // max(1, len(ids)))
    for s in range(0, len(queries), step):
        q = queries[s : s + step]
        d2 = (q * q).sum(axis=1)[:, None] + norms[None, :] - 2 * q @ index.T
        if own is not None:
            d2[own[s : s + step, None] == ids[None, :]] = np.inf
        near = min(len(ids), k + 8)
        pick = np.argpartition(d2, near - 1, axis=1)[:, :near]
        diff = index[pick] - q[:, None, :]
        exact = np.sqrt(np.maximum((diff * diff).sum(axis=2), 0))
        exact[~np.isfinite(np.take_along_axis(d2, pick, axis=1))] = np.inf
        order = np.lexsort((ids[pick], exact), axis=1)[:, :k]
        out_d[s : s + step] = np.take_along_axis(exact, order, axis=1)
        out_i[s : s + step] = np.take_along_axis(ids[pick], order, axis=1)
        # where more rows tie with the k-th than were picked, all of them are compared
        limit = np.partition(d2, k - 1, axis=1)[:, k - 1] + 1e-9 * ((q * q).sum(axis=1) + norms.max(initial=0.0))
        for row in np.flatnonzero((d2 <= limit[:, None]).sum(axis=1) > near):
            tied = np.flatnonzero((d2[row] <= limit[row]) & np.isfinite(d2[row]))
            diff = index[tied] - q[row]
            dist = np.sqrt((diff * diff).sum(axis=1))
            order = np.lexsort((ids[tied], dist))[:k]
            out_d[s + row, : len(order)], out_i[s + row, : len(order)] = dist[order], ids[tied][order]
    return out_d, out_i


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between the rows of two small sets, in blocks of bounded memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 100_000 // max(1, b.size))
    for s in range(0, len(a), step):
        diff = a[s : s + step, None, :] - b[None, :, :]
        out[s : s + step] = np.sqrt((diff * diff).sum(axis=2))
    return out


def index_cells(n: int, width: int, centre_values: int = CENTRE_VALUES) -> int:
    """Cells for n rows: their square root, as long as the centres stay within ``centre_values`` numbers."""
    return max(1, min(int(np.ceil(np.sqrt(n))), centre_values // max(1, width)))


@dataclass(frozen=True)
class Centres:
    """Centres of the cells, and the groups they belong to, each around one of the centres."""

    cell: np.ndarray
    group: np.ndarray
    of_group: list[np.ndarray]
    group_of: np.ndarray

    @classmethod
    def of(cls, drawn: np.ndarray) -> Centres:
        cell = np.unique(drawn, axis=0)  # copies of a row are one centre
        shuffled = np.random.default_rng(7).permutation(len(cell))
        group = cell[shuffled[: int(np.ceil(np.sqrt(len(cell))))]]
        group_of = np.concatenate([np.argmin(distances(c, group), axis=1) for c in np.array_split(cell, max(1, len(cell) // 10_000))])
        return cls(cell, group, [np.flatnonzero(group_of == g) for g in range(len(group))], group_of)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Cell of each row within its nearest group, the distances to both, and how many distances it took."""
        to_group = distances(x, self.group)
        g = np.argmin(to_group, axis=1)
        cell, r, work = np.empty(len(x), np.int64), np.empty(len(x)), to_group.size
        for j in np.unique(g):
            rows, own = np.flatnonzero(g == j), self.of_group[j]
            d = distances(x[rows], self.cell[own])
            at = np.argmin(d, axis=1)
            cell[rows], r[rows] = own[at], d[np.arange(len(rows)), at]
            work += d.size
        return cell, r, to_group[np.arange(len(x)), g], work


@dataclass(frozen=True)
class Bounds:
    """What prunes the search: per cell its greatest and least radius and unit, per group its radius; per unit its first and last shelf; and for groups the distances of the rows nearest to the centre."""

    radius: np.ndarray
    inner: np.ndarray
    unit: np.ndarray
    group_radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    near_group: np.ndarray
    near_r: np.ndarray


def vectors(column: pd.Series, width: int) -> np.ndarray:
    """Rows of ``width`` doubles; a null is a row of no numbers."""
    rows = [np.full(width, np.nan) if v is None else v for v in column.tolist()]
    return np.concatenate(rows).astype(float).reshape(len(rows), width) if rows else np.empty((0, width))


def _units(group_of: np.ndarray, sizes: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each cell and the parts of each unit: neighbours of a group share a unit up to ``block_rows`` rows, larger cells stand alone in several parts."""
    unit, parts = np.full(len(sizes), -1, np.int64), []
    open_group, room = -1, 0
    for c in np.argsort(group_of, kind="stable"):
        if not sizes[c]:
            continue
        if sizes[c] > block_rows:
            unit[c] = len(parts)
            parts.append(-(-int(sizes[c]) // block_rows))
            open_group = -1
            continue
        if group_of[c] != open_group or sizes[c] > room:
            parts.append(1)
            open_group, room = group_of[c], block_rows
        unit[c] = len(parts) - 1
        room -= sizes[c]
    return unit, np.array(parts, np.int64)


def _shelves(parts: np.ndarray, rows: np.ndarray, shelf_rows: int) -> pd.DataFrame:
    """Per unit its first and last shelf, how many of its parts stand on the first and how many on each further one."""
    out, shelf, room = [], 0, shelf_rows
    for p, n in zip(parts.tolist(), rows.tolist()):
        each = max(1, -(-n // p))
        per = max(1, shelf_rows // each)
        if each > room and room < shelf_rows:
            shelf, room = shelf + 1, shelf_rows
        head = min(p, max(1, room // each))
        first, rest = shelf, p - head
        shelf += -(-rest // per)
        room = shelf_rows - each * ((rest - 1) % per + 1) if rest else room - head * each
        out.append((first, shelf, head, per))
    return pd.DataFrame(out, columns=["_first", "_last", "_head", "_per"])


class _Best:
    """The k nearest rows found so far for each of some queries, and the distance that they do not exceed."""

    def __init__(self, k: int, bound: np.ndarray):
        self.k, self.limit = k, bound.copy()
        self.d, self.i = np.full((len(bound), k), np.inf), np.full((len(bound), k), np.iinfo(np.int64).max)
        self.held, self.n = [], 0

    def slack(self, rows: np.ndarray) -> np.ndarray:
        return self.limit[rows] * (1 + 1e-9) + 1e-9

    def add(self, rows: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        self.held.append((rows, dist, ids))
        self.n += len(rows)
        if self.n > self.d.size:
            self.settle()

    def settle(self) -> None:
        if not self.n:
            return
        rows, dist, ids = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.n = [], 0
        near = dist <= self.slack(rows)
        who = np.unique(rows[near])
        rows = np.concatenate([np.repeat(who, self.k), rows[near]])
        dist, ids = np.concatenate([self.d[who].ravel(), dist[near]]), np.concatenate([self.i[who].ravel(), ids[near]])
        by = np.lexsort((ids, dist, rows))
        rows = rows[by]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = rank < self.k
        self.d[rows[top], rank[top]], self.i[rows[top], rank[top]] = dist[by][top], ids[by][top]
        self.limit = np.minimum(self.limit, self.d[:, -1])


class Shelf:
    """Rows of cells, by their distance ``r`` to the centre of their cell; of equal rows those of the ``copies`` lowest ids."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, cell: np.ndarray, r: np.ndarray, centre: np.ndarray, copies: int):
        order = np.lexsort((r, cell))
        new = np.append(True, (np.diff(cell[order]) != 0) | (np.diff(r[order]) != 0))[: len(order)]
        alike = np.cumsum(new) - 1  # equal rows are equally far from the same centre
        many = np.bincount(alike)[alike] > copies if len(order) else np.empty(0, bool)
        if many.any():
            some = order[many]
            order = np.concatenate([order[~many], some[copies_kept(x[some], ids[some], copies)]])
            order = order[np.lexsort((r[order], cell[order]))]
        self.x, self.ids, self.r = x[order], ids[order], r[order]
        numbers, self.first, at = np.unique(cell[order], return_index=True, return_inverse=True)
        self.stop = np.append(self.first[1:], len(order))
        self.centre = centre[numbers]
        offset = self.x - self.centre[at.reshape(-1)]
        self.right = np.column_stack([-2 * offset, np.ones(len(order)), self.r**2])  # times (offset, its square, 1) of a query: squares of distances

    def nearest(self, y: np.ndarray, bound: np.ndarray, k: int, own: np.ndarray | None = None, more: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """k smallest distances within each query's bound and their ids, ties to the lower id, and how many distances it took; infinite where rows run out.

        Rows with a query's ``own`` id, at most ``more`` of them, are left out.
        """
        d, i, work = np.full((len(y), k), np.inf), np.full((len(y), k), np.iinfo(np.int64).max), 0
        finite = np.flatnonzero(np.isfinite(y).all(axis=1))
        step = max(1, min(TILE_QUERIES, TILE // max(1, len(self.centre))))
        for at in range(0, len(finite) if len(self.ids) and k else 0, step):
            rows = finite[at : at + step]
            best = _Best(k, bound[rows])
            work += self._meet_all(y[rows], best, None if own is None else own[rows], k + more)
            d[rows], i[rows] = best.d, best.i
        return d, i, work

    def _meet_all(self, y: np.ndarray, best: _Best, own: np.ndarray | None, kk: int) -> int:
        to_cell = distances(y, self.centre)
        near, far = self.r[self.first], self.r[self.stop - 1]
        work, each, open_ = to_cell.size, np.arange(len(y)), np.ones(to_cell.shape, bool)
        for turn in range(len(self.centre)):
            slack = best.slack(each)[:, None]
            alive = open_ & (to_cell - far <= slack) & (to_cell + slack >= near)
            if turn >= FIRST_CELLS and np.count_nonzero(alive) > FEW_CELLS * len(y):
                break  # little is pruned: each cell meets all its queries at once
            live = np.flatnonzero(alive.any(axis=1))
            if not len(live):
                return work
            cell = np.argmin(np.where(alive[live], to_cell[live], np.inf), axis=1)
            for c in np.unique(cell):
                work += self._meet(c, live[cell == c], y, to_cell, best, own, kk)
            best.settle()
            open_[live, cell] = False
        for c in np.argsort(to_cell.mean(axis=0)):
            work += self._meet(c, np.flatnonzero(open_[:, c]), y, to_cell, best, own, kk)
        best.settle()
        return work

    def _meet(self, c: int, rows: np.ndarray, y: np.ndarray, to_cell: np.ndarray, best: _Best, own: np.ndarray | None, kk: int) -> int:
        d, slack, r = to_cell[rows, c], best.slack(rows), self.r[self.first[c] : self.stop[c]]
        go = (d - r[-1] <= slack) & (d + slack >= r[0])
        rows, d, slack = rows[go], d[go], slack[go]
        if not len(rows):
            return 0
        lo = self.first[c] + np.searchsorted(r, (d - slack).min())
        hi = self.first[c] + np.searchsorted(r, (d + slack).max(), "right")
        left = np.column_stack([y[rows] - self.centre[c], d * d, np.ones(len(rows))])
        for at in range(lo, hi, step := max(1, TILE // len(rows))):
            end = min(hi, at + step)
            d2 = left @ self.right[at:end].T
            off = 1e-11 * (d + self.r[end - 1]) ** 2  # more than the product loses
            limit = slack * slack + off
            met = d2 <= limit[:, None]
            if end - at > 2 * kk and len(wide := np.flatnonzero(np.count_nonzero(met, axis=1) > 2 * kk)):
                kth = np.partition(d2[wide], kk - 1, axis=1)[:, kk - 1]
                met[wide] = d2[wide] <= np.minimum(limit[wide], kth + 2 * off[wide])[:, None]
            q, who = np.divmod(np.flatnonzero(met), end - at)
            q, who = rows[q], who + at
            dist = np.empty(len(q))
            for s in range(0, len(q), piece := max(1, TILE // max(1, y.shape[1]))):
                diff = self.x[who[s : s + piece]] - y[q[s : s + piece]]
                dist[s : s + piece] = np.sqrt((diff * diff).sum(axis=1))
            ids = self.ids[who]
            if own is not None:
                other = ids != own[q]
                q, dist, ids = q[other], dist[other], ids[other]
            best.add(q, dist, ids)
        return len(rows) * max(0, hi - lo)


class MetricIndex:
    """A frame ``_i`` (long), ``_x`` (array of finite numbers) of ``n`` rows of ``width`` numbers, prepared for search; ``own`` rows have the same id at most."""

    def __init__(self, idx: DataFrame, n: int, width: int, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, centre_values: int = CENTRE_VALUES, work: Accumulator | None = None, own: int = 1):
        self.k, self.width, self.query_rows, self.work, self.n, self.own = k, width, query_rows, work, n, own
        drawn = idx.orderBy(hash32(F.col("_i"), 11), "_i").limit(index_cells(n, width, centre_values)).select("_x").toPandas()  # at most centre_values numbers
        centres = Centres.of(vectors(drawn["_x"], width))
        self.spark = idx.sparkSession
        self.centres = self.spark.sparkContext.broadcast(centres)
        held = self.centres

        def place(batches):
            for b in batches:
                if len(b):
                    cell, r, to_group, _ = held.value.nearest(vectors(b["_x"], width))
                    yield b.assign(_cell=cell.astype("int32"), _r=r, _rg=to_group)

        self.placed = cut(idx.mapInPandas(place, f"_i long, _x {dict(idx.dtypes)['_x']}, _cell int, _r double, _rg double"))
        sizes, radius, inner = np.zeros(len(centres.cell), np.int64), np.zeros(len(centres.cell)), np.zeros(len(centres.cell))
        group_radius = np.full(len(centres.group), -np.inf)
        per_cell = self.placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_r").alias("far"), F.min("_r").alias("near"), F.max("_rg").alias("group"))
        for r in per_cell.collect():  # one row a cell
            c = r["_cell"]
            sizes[c], radius[c], inner[c] = r["n"], r["far"], r["near"]
            group_radius[centres.group_of[c]] = max(group_radius[centres.group_of[c]], r["group"])
        unit, self.parts = _units(centres.group_of, sizes, block_rows)
        shelves = _shelves(self.parts, np.bincount(unit[unit >= 0], sizes[unit >= 0], len(self.parts)).astype(np.int64), max(1, min(SHELF_ROWS, SHELF_VALUES // max(1, width))))
        pairs = ",".join(map(str, centres.group_of))
        in_group = self.placed.select(F.element_at(F.split(F.lit(pairs), ",").cast("array<int>"), F.col("_cell") + 1).alias("_g"), "_rg", "_i")
        closest = Window.partitionBy("_g").orderBy("_rg", "_i")
        near = in_group.withColumn("_n", F.row_number().over(closest)).where(F.col("_n") <= k + own).select("_g", "_rg").toPandas()  # k + own rows a group
        bounds = Bounds(radius, inner, unit, group_radius, shelves["_first"].to_numpy(np.int64), shelves["_last"].to_numpy(np.int64), near["_g"].to_numpy(np.int64), near["_rg"].to_numpy(float))
        self.bounds = self.spark.sparkContext.broadcast(bounds)
        cells = pd.DataFrame({"_cell": np.arange(len(unit)), "_unit": unit}).astype("int32")
        self.rows = self.placed.select("_i", "_x", "_cell", "_r").join(F.broadcast(self.spark.createDataFrame(cells)), "_cell")  # as many rows as there are cells
        units = shelves.assign(_unit=np.arange(len(self.parts)), _parts=self.parts).astype({"_unit": "int32"})
        part = _slot("_i", 5, "_parts")
        shelf = F.when(part < F.col("_head"), F.col("_first")).otherwise(F.col("_first") + 1 + F.floor((part - F.col("_head")) / F.col("_per")))
        self.shelved = self.rows.join(F.broadcast(self.spark.createDataFrame(units)), "_unit").select("_i", "_x", "_cell", "_r", shelf.cast("int").alias("_shelf"))

    def _seeds(self, qs: DataFrame, kk: int) -> DataFrame:
        """Each query with the unit of its nearest cell and a first bound of its k-th distance; queries that are not finite have no neighbours."""
        centres, bounds, total, work, width = self.centres, self.bounds, self.n, self.work, self.width

        def run(batches):
            c, b = centres.value, bounds.value
            for batch in batches:
                for at in range(0, len(batch), step := max(1, 4_000_000 // max(1, len(b.near_r)))):
                    part = batch.iloc[at : at + step]
                    y = vectors(part["_y"], width)
                    finite = np.isfinite(y).all(axis=1)
                    part, y = part[finite], y[finite]
                    if not len(part):
                        continue
                    to_group = distances(y, c.group)
                    to_group[:, ~np.isfinite(b.group_radius)] = np.inf  # empty groups
                    limit = np.full(len(y), np.inf)
                    if total >= kk:
                        limit = np.partition(to_group[:, b.near_group] + b.near_r[None, :], kk - 1, axis=1)[:, kk - 1]
                    g, unit, n = np.argmin(to_group, axis=1), np.empty(len(y), np.int64), to_group.size
                    for j in np.unique(g):
                        rows, own = np.flatnonzero(g == j), c.of_group[j]
                        own = own[b.unit[own] >= 0]
                        d = distances(y[rows], c.cell[own])
                        unit[rows] = b.unit[own[np.argmin(d, axis=1)]]
                        n += d.size
                    if work is not None:
                        work.add(n)
                    yield pd.DataFrame({"_q": part["_q"].to_numpy(), "_y": part["_y"].to_numpy(), "_unit": unit.astype("int32"), "_bound": limit})

        return qs.mapInPandas(run, f"_q long, _y {dict(qs.dtypes)['_y']}, _unit int, _bound double")

    def _first_visits(self, seeded: DataFrame) -> DataFrame:
        """One row for each shelf that holds rows of the query's nearest unit."""
        ends = pd.DataFrame({"_unit": np.arange(len(self.parts)), "_first": self.bounds.value.first, "_last": self.bounds.value.last}).astype("int32")
        ends = F.broadcast(self.spark.createDataFrame(ends))  # one row a unit
        return seeded.join(ends, "_unit").select("_q", "_y", F.explode(F.sequence("_first", "_last").cast("array<int>")).alias("_shelf"), "_bound")

    def _visits(self, seeded: DataFrame) -> DataFrame:
        """One row for each further shelf that can still hold one of a query's k nearest."""
        centres, bounds, work, width = self.centres, self.bounds, self.work, self.width

        def run(batches):
            c, b = centres.value, bounds.value
            for batch in batches:
                if not len(batch):
                    continue
                y, limit, seed = vectors(batch["_y"], width), batch["_bound"].to_numpy(float), batch["_unit"].to_numpy(np.int64)
                slack = limit * (1 + 1e-9) + 1e-9
                to_group = distances(y, c.group)
                alive = to_group - b.group_radius[None, :] <= slack[:, None]
                queries, shelves, n = [], [], to_group.size
                for j in range(len(c.group)):
                    rows, own = np.flatnonzero(alive[:, j]), c.of_group[j]
                    own = own[b.unit[own] >= 0]
                    if not len(rows) or not len(own):
                        continue
                    d = distances(y[rows], c.cell[own])
                    n += d.size
                    go = (d - b.radius[own][None, :] <= slack[rows, None]) & (d + slack[rows, None] >= b.inner[own][None, :])
                    r, at = np.nonzero(go)
                    r, unit = rows[r], b.unit[own[at]]
                    many = b.last[unit] - b.first[unit] + 1
                    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    pairs = np.unique(np.stack([np.repeat(r, many), np.repeat(b.first[unit], many) + place]), axis=1)
                    queries.append(pairs[0]), shelves.append(pairs[1])
                if work is not None:
                    work.add(n)
                if not queries:
                    continue
                rows, shelf = np.unique(np.stack([np.concatenate(queries), np.concatenate(shelves)]), axis=1)
                new = (shelf < b.first[seed[rows]]) | (shelf > b.last[seed[rows]])
                rows, shelf = rows[new], shelf[new]
                yield pd.DataFrame({"_q": batch["_q"].to_numpy()[rows], "_y": batch["_y"].to_numpy()[rows], "_shelf": shelf.astype("int32"), "_bound": limit[rows]})

        return seeded.mapInPandas(run, f"_q long, _y {dict(seeded.dtypes)['_y']}, _shelf int, _bound double")

    def _search(self, visits: DataFrame, exclude_self: bool) -> DataFrame:
        """For each query and shelf the k nearest rows there within the query's bound, and the k-th distance if there are so many."""
        load = {r["_shelf"]: r["n"] for r in visits.groupBy("_shelf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a shelf
        # as many queries a task as its memory bears, as long as all cores have several tasks
        fair = -(-sum(load.values()) // (4 * self.spark.sparkContext.defaultParallelism))
        tray = max(1, min(TRAY_VALUES // max(1, self.width), max(fair, min(self.query_rows, TRAY_ROWS))))
        plan = pd.DataFrame([(s, -(-n // tray)) for s, n in load.items()], columns=["_shelf", "_chunks"], dtype="int32")
        plan = F.broadcast(self.spark.createDataFrame(plan, "_shelf int, _chunks int"))
        centres, k, work, width, more = self.centres, self.k, self.work, self.width, self.own if exclude_self else 0
        # both sides' keys are ints: a long has another hash, and frames made of pandas rows have longs in sessions without Arrow
        left = visits.join(plan, "_shelf").select("_q", "_y", "_bound", "_shelf", _slot("_q", 3, "_chunks").alias("_chunk"))
        right = self.shelved.join(plan, "_shelf").select("_i", "_x", "_cell", "_r", "_shelf", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"))

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            keys, d, i = a["_q"].to_numpy(np.int64), np.empty((len(a), k)), np.empty((len(a), k), np.int64)
            if len(a) and len(b):
                shelf = Shelf(vectors(b["_x"], width), b["_i"].to_numpy(np.int64), b["_cell"].to_numpy(np.int64), b["_r"].to_numpy(float), centres.value.cell, k + more)
                d, i, n = shelf.nearest(vectors(a["_y"], width), a["_bound"].to_numpy(float), k, keys if exclude_self else None, more)
                if work is not None:
                    work.add(n)
            else:
                d[:] = np.inf
            found = np.isfinite(d)
            some = np.flatnonzero(found[:, 0])
            lists = {"_kth": [d[r, -1] if found[r, -1] else None for r in some], "distances": [d[r][found[r]] for r in some], "neighbour_ids": [i[r][found[r]] for r in some]}
            return pd.DataFrame({"_q": keys[some], **{c: pd.Series(v, dtype=object) for c, v in lists.items()}})

        keys = ["_shelf", "_chunk"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, f"_kth double, {NEAR_SCHEMA}")

    def search(self, qs: DataFrame, exclude_self: bool = False) -> DataFrame:
        """(_q, distances, neighbour_ids): the k nearest rows of each query ``_q``, ``_y``; query keys must differ."""
        seeded = cut(self._seeds(qs, self.k + self.own * int(exclude_self)))
        first = cut(self._search(self._first_visits(seeded), exclude_self))
        kth = first.groupBy("_q").agg(F.min("_kth").alias("_kth"))
        seeded = seeded.join(kth, "_q", "left").withColumn("_bound", F.least("_bound", "_kth")).drop("_kth")  # least leaves nulls out
        more = self._search(cut(self._visits(seeded)), exclude_self)
        found = first.unionByName(more).groupBy("_q").agg(F.flatten(F.collect_list(F.arrays_zip(F.col("distances").alias("distance"), F.col("neighbour_ids").alias("id")))).alias("p"))
        packed = found.select("_q", F.slice(F.array_sort("p"), 1, self.k).alias("p"))  # at most k of each shelf that a query visits
        return qs.select("_q").join(packed, "_q", "left").select(
            "_q",
            F.coalesce(F.col("p.distance"), F.array().cast("array<double>")).alias("distances"),
            F.coalesce(F.col("p.id"), F.array().cast("array<long>")).alias("neighbour_ids"),
        )


def _slot(key: str, seed: int, parts: str) -> Column:
    return F.floor(hash32(F.col(key), seed) * F.col(parts) / F.lit(SPACE)).cast("int")
