import zlib
from collections import defaultdict

from leadspark.llm import sharding
from tests.llm.frames import PROSE, awkward, cluttered, docs


def check(rows, source, shards):
    texts = defaultdict(set)
    by_shard = defaultdict(list)
    assert len(rows) == len(source)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        texts[(r["size"], r["text_crc32"])].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in texts.values())
    own = sorted(((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in source))
    assert own == sorted((r["size"], r["text_crc32"]) for r in rows)


def test_shards_of_the_table(spark, sf):
    src = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.deal(src).collect()
    check(rows, [r["text"] for r in src.collect()], 40)


def test_loads_are_near_equal(spark):
    texts = [PROSE[: 20 + i % 90] + str(i) for i in range(4000)]
    rows = sharding.deal(docs(spark, texts), shards=7, units=64).collect()
    check(rows, texts, 7)
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.01 * max(load.values())


def test_schedule_is_longest_first():
    assert sharding.schedule({"a": 7, "b": 6, "c": 5, "d": 4, "e": 3}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}
    assert sharding.schedule({}, 3) == {}


def test_awkward_tables(spark):
    df = awkward(spark)
    check(sharding.deal(df, 3).collect(), [r["text"] for r in df.collect()], 3)
    assert sorted(map(repr, sharding.deal(cluttered(df), 3).collect())) == sorted(map(repr, sharding.deal(df, 3).collect()))
    assert sharding.deal(df.limit(0)).count() == 0


def test_hot_group_keeps_slots_gapless(spark):
    texts = ["one text that is copied very often"] * 500 + [PROSE + str(i) for i in range(500)]
    check(sharding.deal(docs(spark, texts), 5, 8).collect(), texts, 5)
