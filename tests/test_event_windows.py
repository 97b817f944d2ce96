"""Windows by event time: late events, restarts, and equality with the batch roll-up."""

from datetime import datetime, timedelta

from leadspark.streaming import event_windows as E

DAY = datetime(2024, 3, 1)


def add(spark, folder, events):
    """One more file of (hours after the first day, type)."""
    rows = [(None if h is None else DAY + timedelta(hours=h), kind) for h, kind in events]
    spark.createDataFrame(rows, "ts timestamp, event_type string").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def counts(spark, folder, **settings):
    return E.window_counts(E.event_stream(spark, str(folder), files_per_batch=1), **settings)


def rows(df):
    return sorted(((r["window_start"] - DAY).total_seconds() / 3600, r["event_type"] or "", r["count"]) for r in df.collect())


def test_events_beyond_the_watermark_are_left_out_and_those_within_it_count(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    add(spark, folder, [(1, "a"), (2, "a"), (3, None), (None, "a"), (25, "b")])
    assert rows(E.closed_windows(spark, counts(spark, folder), out)) == []  # 25 - 2 hours: the first day is open
    add(spark, folder, [(23, "a"), (27, "b")])  # late, but within two hours
    assert rows(E.closed_windows(spark, counts(spark, folder), out)) == [(0, "", 1), (0, "a", 3)]
    add(spark, folder, [(5, "a"), (26, "b"), (60, "c")])  # the first belongs to a closed day
    assert rows(E.closed_windows(spark, counts(spark, folder), out)) == [(0, "", 1), (0, "a", 3), (24, "b", 3)]


def test_closed_windows_equal_the_batch_roll_up(spark, tmp_path):
    folder = tmp_path / "in"
    for day in range(6):  # in order, so nothing is late
        add(spark, folder, [(24 * day + h % 24, "ab"[h % 2]) for h in range(5 + day)])
    batch = rows(E.window_counts(spark.read.parquet(f"{folder}/events.parquet")))
    closed = rows(E.closed_windows(spark, counts(spark, folder)))
    assert closed == [r for r in batch if r[0] < 120] and len(closed) == 10


def test_other_windows_and_delays(spark, tmp_path):
    folder = tmp_path / "in"
    add(spark, folder, [(h / 2, "a") for h in range(20)])
    got = rows(E.closed_windows(spark, counts(spark, folder, window="3 hours", delay="30 minutes")))
    assert got == [(0, "a", 6), (3, "a", 6), (6, "a", 6)]


def test_no_events_give_no_windows(spark, tmp_path):
    spark.createDataFrame([], "ts timestamp, event_type string").write.parquet(f"{tmp_path}/in/events.parquet")
    assert E.closed_windows(spark, counts(spark, tmp_path / "in")).collect() == []
