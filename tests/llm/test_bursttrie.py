import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from leadspark.llm import bursttrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    """All nodes by dictionaries, as the contract says; turns of one conversation must differ in number."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    members = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + x[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, len(seq)))
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    out, below = [], {}
    for path in sorted(members, key=len, reverse=True):
        m = [c for c, _ in members[path]]
        saved = (len(m) - 1) * (len(path[-1][1]) if path else 0) + sum(below[k][0] for k in kids.get(path, []))
        leaves = sum(below[k][1] for k in kids.get(path, [])) or 1
        below[path] = saved, leaves
        ends = ",".join(str(c) for c in sorted(c for c, n in members[path] if n == len(path)))
        out.append((min(m), len(path), min(c for c, _ in members[path[:-1]]) if path else None, len(m), len(kids.get(path, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def table(seed, n=40, longest=12, words=3):
    """Few different turns, so that conversations share much; ids around multiples of 100."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([0, 100, 200, 300]) + rng.randrange(14)
        if any(r[0] == c for r in rows):
            continue
        first = rng.random() < 0.2
        rows += [(c, None if first and i == 0 else i, rng.choice(["user", None]), rng.choice(["a", "bb", "ccc é"][:words])) for i in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


def check(spark, rows, **settings):
    got = bursttrie.trie(spark.createDataFrame(rows, SCHEMA), **settings)
    assert got.columns == COLUMNS
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, by_hand(rows)))


@pytest.mark.parametrize("size, container, seed", [(256, 50_000, 1), (4, 6, 1), (3, 0, 2), (64, 10, 2)])
def test_nodes_by_hand(spark, size, container, seed):
    check(spark, table(seed), size=size, container=container)


def test_long_conversation_among_copies(spark):
    same = [(c, i, "user", f"turn {i}") for c in range(100, 130) for i in range(9)]
    long = [(230, i, "user", f"turn {i % 7}") for i in range(300)] + [(231, i, "user", f"turn {i % 7}") for i in range(290)]
    check(spark, same + long, size=8, container=20)


def test_turns_of_equal_number_come_in_one_order_and_rows_without_an_id_are_left_out(spark):
    rows = [(7, 1, "user", "x"), (7, 1, "user", "y"), (7, None, None, None), (7, 1, "user", "x"), (None, 0, "user", "z")]
    once = [tuple(r) for r in bursttrie.trie(spark.createDataFrame(rows, SCHEMA)).orderBy("depth").collect()]
    again = [tuple(r) for r in bursttrie.trie(spark.createDataFrame(rows[::-1], SCHEMA)).orderBy("depth").collect()]
    assert once == again and len(once) >= 1 and {r[0] for r in once} == {7}


def test_awkward_rows(spark):
    rows = [(0, 0, None, None), (0, 1, "user", ""), (-150, 0, "user", "é" * 70_000), (-100, 0, "user", "b"), (5, 3, "a:", "b"), (9, 3, "a", ":b"), (1, 0, "user", "only turn")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(c) for c in "id chars pos part at k past suffix name base head".split()))
    got = sorted(map(str, map(tuple, bursttrie.trie(df).collect())))
    assert got == sorted(map(str, by_hand_signed(rows)))
    assert bursttrie.trie(df.limit(0)).collect() == []


def by_hand_signed(rows):
    """As :func:`by_hand`, with the sign of SQL's remainder."""
    import math

    class Signed(int):
        def __mod__(self, n):
            return int(math.fmod(int(self), n))

    return [(None if r[0] is None else int(r[0]), r[1], None if r[2] is None else int(r[2]), *r[3:]) for r in by_hand([(Signed(c), *x) for c, *x in rows])]
