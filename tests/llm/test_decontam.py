import hashlib
import random
import re

import numpy as np

from leadspark.llm import decontam
from leadspark.llm.fmindex import FMIndex, suffix_array
from tests.llm.frames import PROSE, awkward, cluttered, docs
from tests.llm.harness import compare


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def by_hand(text, items):
    ws, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        if item is None or not iw:
            continue
        k = min(len(iw), 10)
        grams = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)}
        for i in range(len(ws) - k + 1):
            if tuple(ws[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(str(item))
    ids = ",".join(sorted(found))
    return len(ws), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, PROSE), (2, "Seven wizards, quietly!"), (10, " ".join(words(PROSE)[5:20])), (3, None), (4, "..."), (None, PROSE), (2, "fresh bread"), (5, "ÉTÉ naïve 中文 x")]


def test_index_against_plain_search():
    rng = random.Random(3)
    for sigma, n in ((3, 400), (2, 200), (9, 1), (40, 3000)):
        seq = np.array([rng.randrange(sigma) for _ in range(n)] + [0], np.int64)
        gaps = np.flatnonzero(seq == 0)
        key = lambda i: [(0, int(np.searchsorted(gaps, j))) if seq[j] == 0 else (1, int(seq[j])) for j in range(i, len(seq))]
        if n <= 400:
            assert list(suffix_array(seq)) == sorted(range(len(seq)), key=key)
        index = FMIndex(seq, sigma)
        phrases = np.array([[1, 1, 0, 0], [1, 2, 1, 0], [2, 0, 0, 0], [1, 1, 1, 2], [2, 2, 2, 2]]) % sigma
        phrases = np.where(np.minimum.accumulate(phrases > 0, axis=1), phrases, 0)
        phrases = phrases[phrases[:, 0] > 0]
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            p = p[p > 0]
            want = [i for i in range(len(seq) - len(p) + 1) if (seq[i : i + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


def test_matches_sql(spark, sf):
    diff, rows = compare(spark, "op8_benchmark_decontamination", sf)
    assert diff is None and rows == 200


def test_hits_by_hand(spark):
    texts = [PROSE, "x " + PROSE[10:70] + " y", "seven wizards quietly", "SEVEN (wizards) quietly; fresh bread", "fresh", "été NAÏVE 中文 x", "Été naïve 中文 x", "été naïve 中文 x", PROSE + " " + PROSE]
    df = docs(spark, texts).union(awkward(spark))
    got = decontam.judge(df, bench(spark, ITEMS)).collect()
    want = [by_hand(r["text"], ITEMS) for r in df.collect()]
    assert sorted((r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == sorted(want)


def test_benchmark_in_blocks(spark):
    items = bench(spark, [(i, " ".join(words(PROSE)[i % 7 :])) for i in range(30)])
    shared = decontam.load(items, block_bytes=700)
    assert len(shared) > 3
    whole = decontam.load(items)
    for p in decontam.ts.slices(decontam.pa.array([PROSE, "none of it", PROSE[12:]])):
        a, b = (decontam.hits(p, [x.value for x in y]) for y in (shared, whole))
        assert (a[1] == b[1]).all() and a[2] == b[2]


def test_removal_spans_are_cut(spark):
    tail = " ".join(words(PROSE)[3:15])
    seam = " ".join(words(PROSE)[:5]) + " fresh bread " + " ".join(words(PROSE)[5:12])  # cutting two words makes a new hit
    texts = ["before. " + PROSE + " After!", PROSE, None, "clean text", "a " + tail.upper() + ", b", seam + " end"]
    df = docs(spark, texts)
    got = {r["doc_id"]: r for r in decontam.remove(df, bench(spark, ITEMS)).collect()}
    assert got[0]["text"] == "before.  After!" and got[0]["n_chars"] == len("before.  After!")
    assert set(got) == {0, 2, 3, 4, 5} and got[2]["text"] is None and got[3]["text"] == "clean text"
    assert got[4]["text"] == "a , b" and words(got[5]["text"]) == ["end"]
    again = decontam.judge(decontam.remove(df, bench(spark, ITEMS)), bench(spark, ITEMS))
    assert again.filter("contaminated").count() == 0


def test_awkward_tables(spark):
    df, items = awkward(spark), bench(spark, ITEMS)
    assert sorted(map(repr, decontam.judge(cluttered(df), items).collect())) == sorted(map(repr, decontam.judge(df, items).collect()))
    assert decontam.judge(df.limit(0), items).count() == 0
    assert decontam.judge(df, items.limit(0)).filter("contaminated").count() == 0
    assert decontam.remove(cluttered(df), items).columns == cluttered(df).columns
    assert decontam.remove(df, items.limit(0)).count() == df.count()
