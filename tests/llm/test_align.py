import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from leadspark.llm import align, tokens
from leadspark.llm import textscan as ts
from tests.llm.frames import PROSE, awkward, cluttered, docs

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    return align.sides(tokens.vocabulary(align.VOCABULARY_A), tokens.vocabulary(align.VOCABULARY_B))


def spelled(both, text):
    """(id, bytes) of both sides, by the libraries' own calls on the whole text."""
    a, b = both
    ids = a.encoder.tokenizer.encode(" " + text, add_special_tokens=False).ids
    byte = {c: k for k, c in tokens._byte_letters().items()}
    left = [(i, bytes(byte[c] for c in a.encoder.tokenizer.id_to_token(i))) for i in ids]
    right = []
    for i in b.model.encode(text):
        p = b.model.id_to_piece(i)
        right.append((i, bytes([int(p[3:-1], 16)]) if b.model.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if not text or any(b"".join(x for _, x in side) != want for side in (left, right)):
        return [], []
    return left, right


def by_hand(both, texts):
    """The contract's rows, pair by pair."""
    per, count = [], Counter()
    for t in texts:
        sides = []
        for side in spelled(both, t or ""):
            at, own = 0, []
            for i, x in side:
                at += len(x)
                own.append((i, at))
            sides.append(own)
        pairs = [(i, j) for i, x in sides[0] for j, y in sides[1] if x == y]
        count.update(pairs)
        ends = sorted({x for _, x in sides[0]} & {y for _, y in sides[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, x in side if low < x <= e) for side in sides))
            low = e
        per.append((len(sides[0]), len(sides[1]), len(ends), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return [(a, b, g, len(p), sum(count[x] == best[x[1]] for x in p), sum(count[x] for x in p), h) for a, b, g, p, h in per]


def texts():
    rng = random.Random(5)
    bits = ["the ", "naïve", " ", "  ", "\n", "\t", "日本", "🙂", "<|endoftext|>", "<s>", "don't", "Über", "12345", "▁", " ", "x", ".", "...", "://", "ﬁ", "é" * 5, "hydroxy", " 3.14"]
    return [None, "", " ", "a", "<|endoftext|>", "</s><unk>", PROSE, PROSE, PROSE * 3] + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


@pytest.mark.parametrize("bounds", [{}, {"block_pairs": 200, "max_blocks": 50}, {"block_pairs": 50, "max_blocks": 1}])
def test_rows_by_hand(spark, both, bounds):
    own = texts()
    got = {r["doc_id"]: r for r in align.aligned(docs(spark, own), **bounds).collect()}
    assert list(got[0].asDict()) == COLUMNS
    for i, want in enumerate(by_hand(both, own)):
        assert tuple(got[i])[1:] == want, (i, own[i])


def test_awkward_rows_and_other_columns(spark, both):
    df = awkward(spark)
    rows = sorted((tuple(r) for r in align.aligned(cluttered(df)).collect()), key=str)
    own = df.collect()
    want = sorted(((r["doc_id"], *x) for r, x in zip(own, by_hand(both, [r["text"] for r in own]))), key=str)
    assert rows == want
    assert align.aligned(df.limit(0)).collect() == []


def test_long_text_in_one_slice_of_its_own(spark, both):
    long = (PROSE + " é\n") * 12_000  # more than one slice holds
    assert len(long) > ts.SLICE_BYTES
    rows = {r["doc_id"]: r for r in align.aligned(docs(spark, ["one", long, PROSE])).collect()}
    a, b = spelled(both, long)
    assert (rows[1]["n_a"], rows[1]["n_b"]) == (len(a), len(b)) and rows[1]["n_links"] == rows[1]["n_groups"] > 100_000


def test_intervals_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        size = int(rng.integers(1, 40))
        cuts = [np.unique(np.append(rng.integers(1, size + 1, int(rng.integers(0, 12))), size)) for _ in range(2)]
        ends = cuts
        starts = [np.concatenate([[0], c[:-1]]) for c in cuts]
        second = np.repeat([0, 1], [len(c) for c in cuts])
        group = align.coalesce(np.concatenate(starts), np.concatenate(ends), second)
        common = sorted(set(cuts[0].tolist()) & set(cuts[1].tolist()))
        assert group.tolist() == [int(np.searchsorted(common, e)) for c in cuts for e in c]
        a, b = align.overlaps(starts[0], ends[0], starts[1], ends[1])
        want = [(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
        assert list(zip(a.tolist(), b.tolist())) == want
