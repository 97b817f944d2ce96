"""Connected components of a graph given as edges.

Each task first turns its own links into stars, which connect the same nodes.
Where there is more than one task's worth of links, alternating large-star and
small-star steps follow until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.session import scratch_path

MAX_ROUNDS = 60
#: Links a task works on, and least number of tasks: the graph is much smaller than the corpus.
LINKS_PER_TASK = 1_000_000
LEAST_TASKS = 8


def _store(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def least_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of links, sorted, and the least node that links connect each with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while len(a):
        low = np.minimum(a, b)
        np.minimum.at(up, a, low)
        np.minimum.at(up, b, low)
        while (up[up] != up).any():
            up = up[up]
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[up]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's links, about LINKS_PER_TASK, a link from each node to the least one that they connect it with."""
    ends = [[b.column(c).to_numpy() for c in "ab"] for b in batches if b.num_rows]
    if ends:
        node, least = least_ends(*(np.concatenate(x) for x in zip(*ends)))
        inner = node != least
        yield pa.RecordBatch.from_arrays([pa.array(node[inner]), pa.array(least[inner])], names=["a", "b"])


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(tasks)
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.coalesce(tasks).unionByName(least.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b); the component is its least node.

    Neither links nor labels leave the executors; each round is stored below
    ``spark.checkpoint.dir``, which cuts the lineage.
    """
    now = _store(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    needed = -(-now.count() // LINKS_PER_TASK)
    now = _store(now.repartition(max(1, needed), "a").mapInArrow(_stars, "a long, b long"), "stars")
    if needed > 1:
        now = _joined(now, max(LEAST_TASKS, needed))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _joined(now: DataFrame, tasks: int) -> DataFrame:
    """One star for each component."""
    mark = None
    for _ in range(MAX_ROUNDS):
        now = _store(_small_star(_large_star(now, tasks), tasks), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now
        mark = tuple(seen)
    raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
