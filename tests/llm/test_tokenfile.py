import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadspark.llm import rangecoder, tokenfile, tokens
from leadspark.session import scratch_path
from tests.llm.frames import awkward, cluttered


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 100, 2047, 2048, 2049, 9000])
def test_exact_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), rng.integers(0, 3, n), np.zeros(n), np.full(n, 50256), rng.zipf(1.2, n) % 50257, np.arange(n) % 7):
        ids = ids.astype(np.uint16)
        data = rangecoder.pack(ids, 50257)
        assert (rangecoder.unpack(data) == ids).all()


@given(st.lists(st.integers(0, 40), max_size=300), st.integers(1, 60))
@settings(max_examples=60, deadline=None)
def test_any_ids_in_any_blocks(ids, block):
    ids = np.array(ids, np.uint16)
    assert (rangecoder.unpack(rangecoder.pack(ids, 41, block)) == ids).all()


def test_orders_help():
    rng = np.random.default_rng(1)
    bits = lambda ids: 8 * len(rangecoder.pack(ids.astype(np.uint16), 50257)) / len(ids)
    assert bits(np.tile(rng.integers(0, 50257, 64), 400)) < 1  # contexts repeat
    assert bits(rng.zipf(1.5, 40000) % 50257) < 7  # order 0 alone
    assert bits(rng.integers(0, 50257, 40000)) < 17.5


def test_blocks_are_independent_and_checked():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 900, 5 * rangecoder.BLOCK).astype(np.uint16)
    blocks = [ids[i : i + rangecoder.BLOCK] for i in range(0, len(ids), rangecoder.BLOCK)]
    coded = rangecoder.encode(blocks, 900)
    for b, c in zip(blocks, coded):
        assert rangecoder.encode([b], 900) == [c] and (rangecoder.decode([c], [len(b)], 900)[0] == b).all()
    data = bytearray(rangecoder.pack(ids, 900))
    data[-2000] ^= 4
    with pytest.raises(ValueError, match="checksum of block 4"):
        rangecoder.unpack(bytes(data))
    with pytest.raises(ValueError, match="short"):
        rangecoder.unpack(bytes(data[:-1]))
    with pytest.raises(ValueError, match="not a token file"):
        rangecoder.unpack(b"none" + bytes(data[4:]))


def expected(rows):
    enc = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), True)
    at, out = 0, []
    for d, t in rows:
        ids = np.array([*enc.whole(t or ""), 0])
        out.append((d, at, len(ids), tokens.crc(ids)))
        at += len(ids)
    return out


def test_table(spark, sf):
    from leadspark.llm.catalog import QUERIES

    src = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op4_token_files"](spark, sf).orderBy("start").collect()]
    assert got == expected([(r["doc_id"], r["text"]) for r in src.orderBy("doc_id").collect()])


def test_awkward_tables_in_small_segments(spark):
    df = awkward(spark)
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    for src in (df, cluttered(df)):
        target = scratch_path(spark, "t")
        tokenfile.write(src, target, segment_ids=40)
        assert spark.read.parquet(target).count() > 1
        assert [tuple(r) for r in tokenfile.read(spark, target).orderBy("start").collect()] == expected(rows)
    target = scratch_path(spark, "t")
    tokenfile.write(df.limit(0), target)
    assert tokenfile.read(spark, target).count() == 0


def test_blocks_are_dealt_to_even_batches(monkeypatch):
    monkeypatch.setattr(rangecoder, "LANES", 8)
    assert [len(b) for b in rangecoder._batches([5] * 9)] == [9]  # was 8 and 1: each step costs the same for one block as for many
    assert [len(b) for b in rangecoder._batches([5] * 21)] == [7, 7, 7]
    assert rangecoder._batches([1, 3, 2]) == [[1, 2, 0]] and rangecoder._batches([]) == []


def test_rest_of_a_task_joins_its_last_segment(spark):
    wanted = {"spark.sql.shuffle.partitions": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {k: spark.conf.get(k) for k in wanted}
    rows = [(k, f"some words of text number {k}") for k in range(10)]
    target = scratch_path(spark, "t")
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        tokenfile.write(spark.createDataFrame(rows, "doc_id long, text string"), target, segment_ids=20)
        sizes = [r["n_ids"] for r in spark.read.parquet(target).orderBy("segment").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) > 1 and min(sizes) >= 20
    assert [tuple(r) for r in tokenfile.read(spark, target).orderBy("start").collect()] == expected(rows)
