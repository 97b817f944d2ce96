import re
from collections import Counter, defaultdict

import pytest

from leadspark.llm import linefreq
from leadspark.llm.catalog import ORACLES
from tests.llm.frames import PROSE, awkward, cluttered, docs
from tests.llm.harness import compare


def by_hand(text):
    t = text or ""
    ws = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    hit = {i + j for i in range(len(ws) - 4) if grams[tuple(ws[i : i + 5])] > 1 for j in range(5)}
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": len(re.findall("[#*$%&|<>]", t)),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(hit),
    }


def test_base_counts_by_hand(spark):
    df = awkward(spark)
    texts = Counter(r["text"] for r in df.collect())
    got = linefreq.judge(df)
    rows = got.join(df.select("doc_id", "text").distinct(), got["doc_id"].eqNullSafe(df["doc_id"])).collect()
    assert got.count() == df.count() == sum(texts.values())
    for r in rows:
        assert {k: r[k] for k in by_hand(r["text"])} == by_hand(r["text"]), r["text"]


@pytest.mark.parametrize("name", ["op10_quality_rules"])
def test_matches_sql(spark, sf, name):
    assert name in ORACLES
    assert compare(spark, name, sf)[0] is None


def own(i):
    return " ".join(f"w{i}x{j}y{k}" for k, j in enumerate(range(12)))


def letters(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def prose(i, n=12):
    return " ".join(f"{letters(i)}{letters(k)}q" for k in range(n))


def test_common_lines_go_and_depleted_documents_with_them(spark):
    footer = "subscribe to our letter and share this page with all of your friends today please do"
    texts = [prose(i, 30) + "\n" + footer for i in range(60)] + [prose(1000) + "\n" + footer, footer + "\nok " + letters(7)]
    got = {r["doc_id"]: r for r in linefreq.judge(docs(spark, texts, ["h"] * len(texts))).collect()}
    assert all(got[i]["kept"] and got[i]["n_common_words"] == 16 for i in range(61))
    assert not got[61]["kept"] and not got[61]["base_failed"]
    kept = linefreq.keep(docs(spark, texts, ["h"] * len(texts)))
    assert {r["doc_id"] for r in kept.collect()} == set(range(61)) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_clean_texts_lack_common_lines(spark):
    footer = "Subscribe to our letter of 2024 and share this page with all of your friends today please do"
    texts = [prose(i, 30) + "\n\n" + footer.replace("2024", str(1990 + i)) + "\né " + letters(i) for i in range(60)] + [footer + "\nok " + letters(7), prose(2000)]
    df = cluttered(docs(spark, [*texts, texts[0]], ["h"] * 63))
    got = linefreq.clean(df)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.columns == df.columns and set(rows) == {*range(60), 61, 62}
    for i in [*range(60), 62]:
        k = i % 62
        assert rows[i]["text"] == prose(k, 30) + "\n\né " + letters(k) and rows[i]["n_chars"] == len(rows[i]["text"])
    assert rows[61]["text"] == prose(2000)
    plain = cluttered(awkward(spark))
    assert sorted(map(repr, linefreq.clean(plain).collect())) == sorted(map(repr, linefreq.keep(plain).collect()))
    assert linefreq.clean(plain.limit(0)).count() == 0


def test_copies_and_near_copies_do_not_make_their_lines_common(spark):
    lines = [prose(5000 + k) for k in range(10)]
    near = ["\n".join([*lines, prose(i)]) for i in range(80)]
    exact = ["\n".join(prose(9000 + k) for k in range(5))] * 80
    others = [prose(20_000 + i, 30) for i in range(100)]  # copies are less than half of the host's texts
    got = linefreq.judge(docs(spark, near + exact + others, ["h"] * 260)).collect()
    assert all(r["kept"] and r["n_common_words"] < 12 for r in got)


def test_template_lines_with_one_own_line_count_page_by_page(spark):
    """Whatever the hashes: on some hosts a template line would be the least of all."""
    for b in (2, 10, 100):
        texts, hosts = [], []
        for h in range(8):
            template = [prose(100_000 * (h + 1) + 1000 * b + k, 4) for k in range(b)]
            texts += ["\n".join([*template, prose(10_000 * (h + 1) + i, 13)]) for i in range(60)]
            hosts += [f"h{h}"] * 60
        got = linefreq.judge(docs(spark, texts, hosts)).collect()
        assert all(r["n_common_words"] == 4 * b for r in got), b
        assert all(r["kept"] == (13 * 100 >= (13 + 4 * b) * 20) for r in got)


def test_pages_that_differ_in_digits_alone_count_as_copies(spark):
    texts = [prose(3, 14) + f"\nitem {i}" for i in range(90)] + [prose(200 + i, 14) for i in range(10)]
    assert all(r["kept"] and not r["n_common_words"] for r in linefreq.judge(docs(spark, texts, ["h"] * 100)).collect())


def test_limits_hold_per_host(spark):
    footer = prose(777)
    texts = [prose(i) + "\n" + footer for i in range(60)]
    got = linefreq.judge(docs(spark, texts, [f"h{i % 20}" for i in range(60)])).collect()
    assert all(r["n_common_words"] == 0 for r in got)


def test_awkward_tables(spark):
    df = awkward(spark)
    plain = sorted(map(repr, linefreq.judge(df).collect()))
    assert plain == sorted(map(repr, linefreq.judge(cluttered(df)).collect()))
    assert linefreq.judge(df.limit(0)).count() == 0
    assert linefreq.keep(cluttered(df)).columns == cluttered(df).columns
    kept = Counter(r["doc_id"] for r in linefreq.keep(df).collect())
    assert kept == Counter({0: 2, 1: 1, None: 1, 5: 1})
    assert defaultdict(int, kept)[2] == 0 and PROSE
