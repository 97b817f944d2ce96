import hashlib
import random
import re
import time
from collections import defaultdict

from leadspark.llm import pii
from tests.llm.frames import PROSE, awkward, cluttered, docs


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def by_hand(text):
    """Base spans by the contract's patterns, written out plainly."""
    t, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def line(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check_base(row, text):
    want = by_hand(text)
    assert row["base_sha256"] == hashlib.sha256(line(want).encode()).hexdigest(), text
    assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in want) for i in range(4)]
    kept = [s for s in row["spans"].split(",") if s and not s.startswith("ctx_")]
    assert ",".join(kept) == line(want)


def test_base_by_hand(spark):
    rng = random.Random(4)
    bits = ["a", "Z9", "@", ".", "-", " ", "1", "23", "255", "256", "999", "0", "+", "(", ")", "4111111111111111", "4111 1111-1111 1111", "é", "\n", "x@y.z", "١", "%", " ", "+1 (555) 555-0100"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "@a.b", "a@@b.c", "a.b@c-.d..e", "0001.2.3.4", "+12 34 56 78 90 1", "4111111111111111-", "1" * 3000 + ".1.1.1"]
    for row in pii.find(docs(spark, texts)).collect():
        check_base(row, texts[row["doc_id"]])


def test_awkward_rows_and_other_columns(spark):
    df = awkward(spark)
    rows = pii.find(cluttered(df)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in df.collect())
    assert all(r["spans"] == "" and r["n_added"] == 0 for r in rows)
    assert pii.find(df.limit(0)).collect() == []


def test_hostile_and_long_texts_take_linear_time(spark):
    texts = ["a" * 1_500_000, "1" * 1_500_000, "a@" * 700_000, "1." * 700_000, "+1" * 700_000, "1 " * 700_000, "@a." * 500_000, "(1" * 700_000, PROSE * 10_000 + " x@y.zz"]
    t = time.time()
    rows = {r["doc_id"]: r for r in pii.find(docs(spark, texts)).collect()}
    assert time.time() - t < 120
    assert rows[8]["n_email"] == 1 and rows[8]["spans"] == f"email:{len(PROSE) * 10_000 + 1}:{len(texts[8])}"


def corpus():
    """Phone numbers and emails after words of their own; local numbers and odd addresses in the same places; other numbers elsewhere."""
    rng = random.Random(8)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts, hidden, clean = [], {}, []
    for i in range(240):
        if i % 4 == 0:
            texts.append(f"{PROSE} telephone: +1 ({num(3)}) 555-{num(4)} and so on {i}")
        elif i % 4 == 1:
            texts.append(f"the address mailto: user{i}.{num(3)}@mail.example.com was given")
        elif i % 4 == 2:
            word = f"555-{num(4)}" if i % 8 == 2 else f"guest{num(3)}@localhost"
            mark = "telephone:" if i % 8 == 2 else "mailto:"
            texts.append(f"a line with {mark} {word} for you")
            hidden[i] = (texts[i].index(word), texts[i].index(word) + len(word), "ctx_phone" if i % 8 == 2 else "ctx_email")
        else:
            texts.append(f"order number {num(9)} of part {num(7)} in the year")
            clean.append(i)
    return texts, hidden, clean


def test_unseen_identifiers_are_found_by_their_context_and_other_numbers_left_alone(spark):
    texts, hidden, clean = corpus()
    rows = {r["doc_id"]: r for r in pii.find(docs(spark, texts)).collect()}
    for i, (a, b, kind) in hidden.items():
        assert rows[i]["spans"] == f"{kind}:{a}:{b}", texts[i]
    assert all(rows[i]["spans"] == "" for i in clean)
    for i in rows:
        check_base(rows[i], texts[i])


def plain(texts, rounds, least_seeds, least_score):
    """The rounds on dictionaries."""
    seeds, others = set(), set()
    for t in texts:
        base = pii.base_spans(t)
        for spans, to in ((base, seeds), (pii.instances(t, base), others)):
            to.update((p, t[a:b].lower(), k) for a, b, k in spans for p in pii.patterns(t, a, b))
    known, n = defaultdict(set), defaultdict(set)
    for p, i, k in seeds:
        known[p, k].add(i)
        n[p].add((i, k))
    for p, i, k in others:
        n[p].add((i, 100 + k))
    found = {}
    for _ in range(rounds):
        score = {}
        for (p, k), own in known.items():
            if len(own) >= least_seeds:
                here = [(i, b) for q, i, b in others if q == p]
                more = [found[i][0] for i, _ in here if i in found and found[i][1] == k]
                open_kind = sum(b >> k & 1 for _, b in here)
                score[p, k] = (len(own) + sum(more)) / (len(n[p]) - (1 - pii.UNKNOWN) * (open_kind - len(more)) + pii.DOUBT)
        new = {}
        for p, i, bits in others:
            for k in range(4):
                if bits >> k & 1 and score.get((p, k), 0) >= least_score:
                    new[i] = max(new.get(i, (0, -9)), (score[p, k], -k))
        found = {i: (s, -k) for i, (s, k) in new.items()}
    return found


def test_rounds_by_hand(spark):
    texts, _, _ = corpus()
    settings = {"rounds": 3, "least_seeds": 3, "least_score": 0.5}
    want = plain(texts, *settings.values())
    rows = pii.bootstrap(*pii.graph(pii.scan(docs(spark, texts))), **settings).collect()
    assert {r["inst"]: (round(r["score"], 9), r["kind"]) for r in rows} == {pii._key(i): (round(s, 9), k) for i, (s, k) in want.items()}
    assert len(want) >= 60


def test_copies_give_a_pattern_no_weight(spark):
    texts = ["call home: +1 (555) 555-0100 today"] * 50 + ["call home: 555-0199 today"]
    assert all(r["n_added"] == 0 for r in pii.find(docs(spark, texts)).collect())
