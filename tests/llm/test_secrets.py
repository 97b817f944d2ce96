import hashlib
import random
import re

from leadspark.llm import secrets
from tests.llm.frames import PROSE, awkward, cluttered, docs

HEXES = "0123456789abcdef"
CAPS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def by_hand(text):
    """Base spans by the contract's patterns, written out plainly."""
    t, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def word(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def corpus(rng, n=80):
    out = []
    for i in range(n):
        kind = i % 4
        secret = (f"password={word(rng, HEXES, 18)}", f"AKIA{word(rng, CAPS, 16)}", f"id {word(rng, HEXES, 40)} ok", f'api_key: "{word(rng, HEXES, 18)}"')[kind]
        out.append(f"é text {i} before {secret} and after")
    return out


def test_base_by_hand(spark):
    rng = random.Random(1)
    alphabet = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", '"', "'", "AKIA", "ABCDEF12", "deadbeef", "0123456789", "x", "é", "/+", "\n"]
    texts = corpus(rng) + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    df = docs(spark, texts).union(awkward(spark))
    rows = secrets.find(df, least_gain=99).collect()
    want = sorted(by_hand(r["text"]) for r in df.collect())
    assert sorted(r["spans"] for r in rows) == want
    assert sorted(r["base_sha256"] for r in rows) == sorted(hashlib.sha256(w.encode()).hexdigest() for w in want)
    for r in rows:
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [r["spans"].count(k) for k in ("assign", "access", "hex")]


def test_table_by_hand(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in secrets.find(df).collect()}
    for d in df.collect():
        base = by_hand(d["text"])
        assert rows[d["doc_id"]]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(rows[d["doc_id"]]["spans"].split(","))


def test_formats_are_learned_and_held_out_words_told_apart():
    rng = random.Random(5)
    train = [secrets.Automaton([secrets.symbols(w) for w in ws]) for ws in ([word(rng, HEXES, 18) for _ in range(200)] + [word(rng, HEXES, 40) for _ in range(100)], ["AKIA" + word(rng, CAPS, 16) for _ in range(200)])]
    assert train[0].size == 41 and train[1].size == 21  # one state a place: the lengths are kept
    held = [word(rng, HEXES, 18) + "a1"[i % 2] * 0 for i in range(100)] + ["AKIA" + word(rng, CAPS, 16) for _ in range(100)]
    other = [f"mail{i}.example.com" for i in range(40)] + [word(rng, "abcdefghijklmnopqrstuvwxyz", 17) + "7" for _ in range(60)] + [f"2024-05-{i:02}T10-20-30" for i in range(40)] + [word(rng, CAPS, 27) for _ in range(60)]
    assert secrets.held_out_accuracy(train, held, other) > 0.98


def test_states_merge_where_statistics_agree():
    rng = random.Random(9)
    loose = secrets.Automaton(["x" * rng.randint(8, 9) + "-" + "x" * min(40, int(rng.expovariate(0.2))) for _ in range(400)])
    tree = len({s[:k] for s in ["x" * n for n in range(41)] for k in range(len(s))})
    assert loose.size < tree


def test_unlabelled_secret_of_a_known_format_is_added(spark):
    rng = random.Random(2)
    bare = word(rng, HEXES, 18)
    texts = [*corpus(rng), f"see {bare} here", "see mail7.example.com and version1.2.3-build45678 here", PROSE]
    rows = {r["doc_id"]: r for r in secrets.find(docs(spark, texts)).collect()}
    assert rows[80]["spans"] == f"format:4:22" and rows[80]["n_format"] == 1
    assert rows[81]["spans"] == rows[82]["spans"] == ""
    assert all(r["n_format"] == 0 for i, r in rows.items() if i < 80)


MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def mixed_formats(rng):
    """Mixed-case token, prefixed token, base64 with slashes and padding, dotted token."""
    return (
        word(rng, MIXED, 24),
        "ghp_" + word(rng, MIXED, 36),
        word(rng, MIXED + "+/", 40),
        word(rng, MIXED + "+/", 42) + "==",
        ".".join(word(rng, MIXED, n) for n in (36, rng.randint(40, 44), 43)),
    )


def test_mixed_case_base64_and_dotted_formats_are_told_from_words():
    rng = random.Random(8)
    train = [secrets.Automaton([secrets.symbols(w) for _ in range(200) for w in mixed_formats(rng)])]
    held = list(zip(*(mixed_formats(rng) for _ in range(100))))
    words = ["get", "User", "Name", "By", "Index", "Response", "Handler", "Factory", "Config", "parse", "Table", "Stream"]
    camel = lambda n: "".join(rng.choice(words) for _ in range(n))
    other = [(camel(6) + "12")[-24:] for _ in range(100)] + [f"{camel(4)}.{camel(3)}2.{camel(3)}" for _ in range(100)] + [f"src/{camel(3)}/{camel(3)}/v{i}" for i in range(100)]
    for same in held:
        assert secrets.held_out_accuracy(train, same, other) > 0.9


def test_unlabelled_mixed_case_secrets_are_added_and_redacted(spark):
    rng = random.Random(4)
    texts = [f"set token={w} there" for _ in range(60) for w in mixed_formats(rng)[:2]]
    bare = mixed_formats(rng)[:2]
    df = docs(spark, [*texts, *(f"see {w} here" for w in bare), "see getUserNameByIndex99 here"])
    rows = {r["doc_id"]: r["spans"] for r in secrets.find(df).collect()}
    assert [rows[120], rows[121], rows[122]] == ["format:4:28", "format:4:44", ""]
    assert {r["text"] for r in secrets.redact(df).collect() if 120 <= r["doc_id"] <= 121} == {"see [secret] here"}


def test_runs_that_overlap_base_spans_are_scored_whole_and_in_parts(spark):
    rng = random.Random(6)
    key = lambda: "-".join(word(rng, HEXES, n) for n in (32, 8, 8))
    pair = "AKIA" + word(rng, CAPS, 16) + "/" + word(rng, MIXED, 40)
    texts = [f"set token={w} there" for _ in range(40) for w in (key(), word(rng, MIXED, 40))] + [f"see {key()} here", f"see {pair} here"]
    df = docs(spark, texts)
    rows = {r["doc_id"]: r["spans"] for r in secrets.find(df).collect()}
    assert sorted(rows[80].split(",")) == ["format:4:54", "hex:4:36"]
    assert sorted(rows[81].split(",")) == ["access:4:24", "format:25:65"]
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got[80] == "see [secret] here" and got[81] == "see [secret]/[secret] here"


def test_parts_by_hand():
    text = "aaaaaaaaaaaaaaa1-XX/bbbbbbbbbbbbbbb2+YY"
    whole = (0, len(text), text)
    base = [(17, 19, "access", "XX"), (37, 39, "access", "YY")]
    assert secrets.with_parts(text, [whole], base) == [whole, (0, 16, text[:16]), (20, 36, text[20:36])]
    assert secrets.with_parts(text, [whole], [(0, 30, "hex", ""), (20, 39, "hex", "")]) == []


def test_redaction(spark):
    rng = random.Random(2)
    texts = [*corpus(rng), None, "", PROSE]
    got = {r["doc_id"]: r for r in secrets.redact(cluttered(docs(spark, texts))).collect()}
    assert len(got) == len(texts) and got[82]["text"] == PROSE and got[80]["text"] is None
    assert all(by_hand(r["text"]) == "" for r in got.values())
    assert got[1]["text"] == "é text 1 before [secret] and after" and got[1]["n_chars"] == len(got[1]["text"])
    assert secrets.redacted("abcdefgh", [(1, 4), (2, 6), (7, 8)]) == "a[secret]g[secret]"


def test_awkward_tables(spark):
    df = awkward(spark)
    assert sorted(map(repr, secrets.find(cluttered(df)).collect())) == sorted(map(repr, secrets.find(df).collect()))
    assert secrets.find(df.limit(0)).count() == 0 and secrets.redact(df.limit(0)).count() == 0
    assert secrets.redact(df).columns == df.columns and secrets.redact(df).count() == df.count()
