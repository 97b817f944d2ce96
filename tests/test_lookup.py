from pyspark.sql import functions as F

from leadspark.operators import encoders as E
from leadspark.operators import lookup as L


def _hot(spark, n=8000):
    """Half of all rows hold one value, a tenth hold none."""
    v = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id") % 40))
    return spark.range(n).select(F.col("id").alias("row_key"), v.alias("k"), (F.col("id") % 3 == 0).cast("int").alias("target"))


def _table(df):
    return df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("k").isNotNull() & (F.col("k") != "v7"))


def _rows(df, *cols):
    return sorted(df.select(*cols).collect(), key=repr)


def test_broadcast_and_salted_join_agree(spark):
    df = _hot(spark)
    for how in ("left", "inner"):
        small = L.lookup_join(df, _table(df), "k", how)
        wide = L.lookup_join(df, _table(df), "k", how, max_bytes=0, rows_per_salt=500)
        assert set(small.columns) == set(wide.columns) == {"row_key", "k", "target", "n"}
        assert _rows(small, *small.columns) == _rows(wide, *small.columns)


def test_hot_value_is_split_over_tasks(spark):
    df = _hot(spark)
    hot = {r["_salts"] for r in L.hot_keys(df, ["k"], 500).collect()}
    assert hot == {8, 2}  # 4000 rows of one value, 800 without any
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        joined = L.lookup_join(df, _table(df), "k", max_bytes=0, rows_per_salt=500)
        per = joined.groupBy("k", F.spark_partition_id().alias("task")).count().where("k = 'hot'").collect()
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)
    assert sum(r["count"] for r in per) == 4000
    assert len(per) >= 4 and max(r["count"] for r in per) < 2000


def test_number_of_hot_keys_is_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert L.hot_keys(df, ["k"], 1, max_keys=50).count() == 0  # none holds more than a fiftieth
    assert L.hot_keys(df, ["k"], 1, max_keys=200).count() == 100


def test_bytes_decide_and_each_part_alone(spark):
    rows = [("a", str(i), 0.5) for i in range(10)] + [("b", "x" * 10_000 + str(i), 0.5) for i in range(10)]
    table = spark.createDataFrame(rows, "column string, value string, encoding double")
    assert L.fits(table, max_bytes=200_000) and not L.fits(table, max_bytes=50_000) and not L.fits(table, max_rows=19)
    assert L.fitting_parts(table, "column", max_bytes=50_000) == {"a"}
    assert L.fitting_parts(table, "column", max_rows=10) == {"a"}
    assert L.fitting_parts(table, "column") == {"a", "b"}
    assert L.fits(table.limit(0), max_bytes=0)


def test_wide_column_shuffles_alone(spark):
    df = _hot(spark).withColumn("wide", F.concat(F.lit("w" * 200), F.col("row_key") % 500))
    table, prior = E.fit_target_encoding(df, ["k", "wide"])
    apply = lambda **kw: E.apply_target_encoding(df, ["k", "wide"], table, prior, **kw)
    small, mixed = apply(), apply(max_bytes=20_000, rows_per_salt=500)
    assert small.columns == mixed.columns and small.columns[-2:] == ["k_te", "wide_te"]
    assert _rows(small, *small.columns) == _rows(mixed, *small.columns)
    fit = lambda **kw: E.cross_fitted_encoding(df, ["k", "wide"], **kw)
    one, other = fit(), fit(max_bytes=20_000, rows_per_salt=500)
    assert one.columns == other.columns and _rows(one, *one.columns) == _rows(other, *one.columns)


def test_empty_sides(spark):
    df = _hot(spark, 100)
    assert L.lookup_join(df.limit(0), _table(df), "k", max_bytes=0).count() == 0
    none = L.lookup_join(df, _table(df).limit(0), "k", max_bytes=-1)
    assert none.where("n IS NULL").count() == 100
