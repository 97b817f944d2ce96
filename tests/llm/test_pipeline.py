"""The pipeline beside a brute-force version of its stages, and its entry points."""

import re
from collections import Counter

import corpus_pipeline
import pytest

from leadspark.llm import secrets, tokens
from leadspark.session import scratch_path
from tests.llm import test_decontam, test_jaccard, test_linefreq
from tests.llm.frames import awkward, cluttered


@pytest.fixture(scope="module")
def steps(spark, sf):
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_stay(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_quality_stage_keeps_what_the_rules_keep(spark, sf, steps):
    import duckdb

    from leadspark.llm.catalog import ORACLES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op10_quality_rules']}) WHERE kept").fetchall()}
    assert {d for d, _ in rows(steps[1])} == kept
    base = {d: test_linefreq.by_hand(t) for d, t in rows(steps[0])}
    assert all(base[d]["n_words"] >= 10 and 100 * base[d]["n_repeat_words"] <= 20 * base[d]["n_words"] for d in kept)


def test_join_stage_keeps_one_of_each_component(steps):
    want = {c for _, _, c in test_jaccard.by_hand(rows(steps[1]))}
    assert Counter(d for d, _ in rows(steps[2])) == Counter(want)


def test_decontamination_stage_cuts_all_phrases(spark, sf, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = dict(rows(steps[2])), dict(rows(steps[3]))
    for d, t in before.items():
        if not test_decontam.by_hand(t, items)[4]:
            assert after[d] == t
        elif d in after:
            assert len(after[d]) < len(t) and not test_decontam.by_hand(after[d], items)[4]
        else:
            n, hit = test_decontam.by_hand(t, items)[:2]
            assert hit == n


def test_secret_stage_masks_base_spans(steps):
    before, after = dict(rows(steps[3])), dict(rows(steps[4]))
    assert before.keys() == after.keys()
    for d, t in before.items():
        assert not secrets.base_spans(after[d])
        if not secrets.base_spans(t) and secrets.REDACTED not in after[d]:
            assert after[d] == t


def test_packing_stage_holds_all_tokens(steps):
    enc = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False)
    want = Counter({d: len(enc.whole(t)) + 1 for d, t in rows(steps[4])})
    got, bins = Counter(), Counter()
    for r in steps[5].collect():
        got[r["doc_id"]] += r["length"]
        bins[r["sequence_id"]] += r["length"]
    assert got == want and max(bins.values()) <= 2048


def test_run_equals_the_stages(spark, sf, steps):
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(steps[5])


def test_awkward_tables_pass_every_stage(spark, sf):
    for src in (cluttered(awkward(spark)), awkward(spark).limit(0)):
        docs = src
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            path = scratch_path(spark, "t")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (src.count() > 0)


def test_entry_points(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert set(e.oracle_sql()) <= set(names)
