import itertools
from collections import defaultdict

import numpy as np

from leadspark.llm import packing, tokens
from tests.llm.frames import awkward, cluttered


def check(rows, texts, capacity):
    enc = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False)
    want = []
    for d, t in texts:
        ids = np.array([*enc.whole(t or ""), 0])
        want += [(d, k, s, len(ids[s : s + capacity]), tokens.crc(ids[s : s + capacity])) for k, s in enumerate(range(0, len(ids), capacity))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_table(spark, sf):
    src = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(src).collect()
    n = check(rows, [(r["doc_id"], r["text"]) for r in src.collect()], 2048)
    assert n <= packing.lower_bound(np.array([r["length"] for r in rows]), 2048) + 1


def test_awkward_tables(spark):
    df = awkward(spark)
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    check(packing.pack(df, capacity=64).collect(), texts, 64)
    check(packing.pack(cluttered(df), capacity=64).collect(), texts, 64)
    assert packing.pack(df.limit(0)).count() == 0


def fewest(lengths, capacity):
    """Number of bins by trying all placements."""
    best = len(lengths)

    def place(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(lengths):
            best = len(loads)
            return
        for k in range(len(loads)):
            if loads[k] + lengths[i] <= capacity:
                place(i + 1, [*loads[:k], loads[k] + lengths[i], *loads[k + 1 :]])
        place(i + 1, [*loads, lengths[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_fewest_bins():
    rng = np.random.default_rng(2)
    tight = 0
    for k, capacity in itertools.product(range(40), (10, 17, 24)):
        lengths = rng.integers(1, capacity + 1, 1 + k % 8)
        bound, least = packing.lower_bound(lengths, capacity), fewest(lengths.tolist(), capacity)
        assert bound <= least <= packing.best_fit_decreasing(lengths, capacity)[2]
        tight += bound == least
    assert tight > 100
    assert packing.lower_bound(np.array([6, 6, 6, 4]), 10) == 3  # more than the sum alone shows


def test_exchange_saves_bins(spark):
    """Partitions that fit badly on their own fit once they exchange documents."""
    rng = np.random.default_rng(8)
    lengths = rng.integers(30, 800, 3000)
    df = spark.createDataFrame([(i, 0, 0, int(n), 0, i) for i, n in enumerate(lengths)], f"doc_id long, {packing._PIECE}")
    count = lambda out: out.select("sequence_id").distinct().count()
    alone = packing.pack_pieces(df, 2048, group_rows=60, exchanges=0)
    after = packing.pack_pieces(df, 2048, group_rows=60, exchanges=3)
    assert count(after) < count(alone)
    assert count(after) <= packing.lower_bound(lengths, 2048) * 1.01 + 1
    sums = after.groupBy("sequence_id").agg({"length": "sum"}).toPandas().iloc[:, 1]
    assert sums.max() <= 2048 and sums.sum() == lengths.sum() and after.count() == 3000
