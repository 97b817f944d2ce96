import random
import re

import numpy as np
import pytest

from leadspark.llm import components, jaccard
from tests.llm.frames import PROSE, awkward, cluttered, docs


def shingles(text):
    ws = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def by_hand(rows):
    """(doc_id, n_shingles, component_id) of every row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        near = set()
        for g in s:
            near |= index.setdefault(g, set())
            index[g].add(i)
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = [x for x in (least.get(root(i)), d) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return sorted(((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def ours(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.group(df).collect()), key=repr)


def variants(seed, n, size, vocabulary, edits):
    """Texts that differ from each other in some words, at all distances around the threshold."""
    rng = random.Random(seed)
    base = [rng.choice(vocabulary) for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(size)] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [t for k in range(12) for t in variants(seed * 100 + k, 25, 20 + 15 * k, vocabulary, 3 + k)]
    passage = " ".join(vocabulary[:40])
    texts += [f"{passage} {t}" for t in variants(seed, 40, 12, vocabulary, 12)]  # one passage in all, short texts of their own
    rng = random.Random(seed)
    rng.shuffle(texts)
    df = docs(spark, texts)
    got = ours(df)
    assert got == by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
    assert len({c for _, _, c in got}) < len(texts)


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert ours(df) == by_hand([(r["doc_id"], r["text"]) for r in df.collect()])


def test_prefix_filters_lose_nothing():
    rng = np.random.default_rng(5)
    frequent = jaccard.Frequent(np.arange(50, dtype=np.uint64), np.arange(1, 51))
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 200, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 200, 3).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        want = 100 * both >= 75 * len(np.union1d(x, y))
        assert jaccard.similar(x, y, frequent) == want
        if want:
            p, q = frequent.prefix(x, 0), frequent.prefix(y, 0)
            shared = set(p.tolist()) & set(q.tolist())
            assert shared
            t = min(shared, key=p.tolist().index)
            at = lambda a: np.array([a.tolist().index(t)])
            assert jaccard._may_link(np.array([len(x)]), at(p), np.array([len(y)]), at(q))[0]


def test_threshold_is_met_exactly(spark):
    words = [f"q{i}" for i in range(19)]  # 15 shingles; with one changed end word 14 of 16
    at = [" ".join(words), " ".join([*words[:-1], "zz"]), " ".join(words[:12]), " ".join(["aa", "bb", *words[2:]])]
    df = docs(spark, at)
    assert ours(df) == by_hand(list(enumerate(at)))


def test_one_of_each_group_stays(spark):
    base = PROSE.split()
    texts = [PROSE, PROSE, " ".join([*base[:-1], "city"]), "another text with quite different words in every place", None, "", "  "]
    df = docs(spark, texts)
    kept = jaccard.keep_one(cluttered(df.union(df)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 5, 6]
    assert kept.columns == cluttered(df).columns


def test_awkward_tables(spark):
    df = awkward(spark)
    want = by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
    assert ours(df) == ours(cluttered(df)) == want
    assert jaccard.group(df.limit(0)).count() == 0
    assert jaccard.keep_one(df.limit(0)).count() == 0
    assert sorted((r["doc_id"] for r in jaccard.keep_one(df).collect()), key=repr) == [0, 2, 3, 4, 7, None]  # 5 and 6 resemble 0


def cross(token, node, n, pos, comp):
    import pyarrow as pa

    cols = [np.array(c, np.int64) for c in (token, node, n, pos, comp)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "node", "n", "pos", "comp"])
    out = [p for b in jaccard._cross_pairs(iter([batch])) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
    return out


def test_pairs_across_components_are_those_of_all_pairs():
    rng = np.random.default_rng(5)
    for comps in (1, 2, 3, 40):
        m = 300
        token, node = rng.integers(0, 6, m), np.arange(m)
        n, pos, comp = rng.integers(8, 30, m), rng.integers(0, 6, m), rng.integers(0, comps, m)
        want = set()
        for i in range(m):
            for j in range(i):
                if token[i] == token[j] and comp[i] != comp[j] and jaccard._may_link(n[i], pos[i], n[j], pos[j]):
                    want.add((j, i))
        got = cross(token, node, n, pos, comp)
        assert set(got) == want
        assert len(got) == len(want)


def test_a_hot_token_of_one_component_makes_no_pairs():
    m = 100_000
    one = np.zeros(m)
    assert cross(one, np.arange(m), one + 20, one, one) == []
    comp = one.copy()
    comp[7] = 1
    assert len(cross(one, np.arange(m), one + 20, one, comp)) == m - 1


def test_centres_are_rows_of_the_same_token():
    rng = np.random.default_rng(6)
    token, node = np.sort(rng.integers(0, 50, 1_000)), rng.integers(0, 1 << 60, 1_000)
    at = jaccard._centres(token, node, 1)
    assert (token[at] == token).all()
    assert len(np.unique(at)) == len(np.unique(token))
    assert len(jaccard._centres(token[:0], node[:0], 1)) == 0


def test_sketches_lose_no_similar_pair():
    rng = np.random.default_rng(8)
    fit = 0
    for k in range(400):
        n = int(rng.integers(1, [60, 9_000][k % 2]))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.uniform(0.7, 1)], rng.integers(0, 1 << 62, n // 8 + 1).astype(np.uint64)]))
        u, v = jaccard.sketch(x), jaccard.sketch(y)
        assert len(u) >= 64 and len(jaccard.narrowed(u, 64)) == 64
        near = jaccard.sketches_fit(u, len(x), v, len(y))
        assert near or not jaccard.alike(x, y)
        fit += near
        if len(x) > 20:
            z = rng.integers(0, 1 << 62, len(x)).astype(np.uint64)
            assert not jaccard.sketches_fit(u, len(x), jaccard.sketch(z), len(z))
    assert 0 < fit < 400


def test_pairs_of_a_passage_and_of_near_copies_do_not_grow_with_the_square():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    base = np.unique(rng.integers(0, 1 << 62, 40).astype(np.uint64))
    unlike = [np.concatenate([base[:4], rng.integers(0, 1 << 62, 36).astype(np.uint64)]) for _ in range(300)]
    alike = [np.concatenate([base[:39], rng.integers(0, 1 << 62, 1).astype(np.uint64)]) for _ in range(300)]
    m = 600
    cols = [np.zeros(m, np.int64), np.arange(m), np.full(m, 40), np.zeros(m, np.int64), np.arange(m)]
    marks = pa.array([jaccard.sketch(t) for t in unlike + alike], pa.binary())
    batch = pa.RecordBatch.from_arrays([*map(pa.array, cols), marks], names=["token", "node", "n", "pos", "comp", "narrow"])
    count = lambda f: sum(b.num_rows for b in f(iter([batch])))
    assert count(jaccard._cross_pairs) == 300 * 299 // 2  # the similar ones, none of the others; was 600 * 599 / 2
    assert count(jaccard._cross_forest) == 299


@pytest.mark.parametrize("links", [10, 1_000_000])
def test_components_of_links(spark, monkeypatch, links):
    monkeypatch.setattr(components, "LINKS_PER_TASK", links)
    rng = np.random.default_rng(3)
    path = rng.permutation(60).tolist()
    pairs = [*zip(path, path[1:]), *((100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 80, (60, 2))), (-5, -5), (-7, 400), (400, -7)]
    least = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in least:
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    found = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted(least.items())


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup(name := f"count-{id(run)}", "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_links_of_one_task_need_no_rounds(spark):
    """The driver keeps a record of each job, so a long path in a small table must not make many."""
    path = np.random.default_rng(4).permutation(500).tolist()
    links = spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")
    assert jobs_of(spark, lambda: components.components(links)) < 12  # was 109
    assert jaccard.tasks_for(80_000, 200) == 2  # was 200
    assert [jaccard.tasks_for(n, 200) for n in (0, 50_000_000, 900_000_000)] == [1, 200, 900]
