from datetime import datetime

import math

import pytest
from pyspark.sql import functions as F

from leadspark import schema as S
from leadspark.functions import features as X
from leadspark.functions.dates import add_months, ts_literal
from leadspark.functions.hashing import hash32, hash32_sql
from leadspark.operators.panel import PanelSpec, add_company_features, add_temporal_features, current_prospects, modeling_panel
from leadspark.sources.tables import companies, rename_master


def _one(df):
    return df.first()


def dated(spark, rows, schema="founding_year int, snapshot_date timestamp_ntz"):
    return spark.createDataFrame(rows, schema)


def test_age_at_snapshot(spark):
    d = datetime(2024, 6, 15)
    df = dated(spark, [(2010, d), (2015, d), (2020, d), (None, d), (2030, d)])
    assert [r[0] for r in df.select(X.company_age(F.col("founding_year"), F.col("snapshot_date"))).collect()] == [14, 9, 4, 0, 0]


def test_log_age(spark):
    d = datetime(2024, 6, 15)
    out = add_temporal_features(dated(spark, [(2014, d), (2024, d)])).select("company_age_log").collect()
    assert out[0][0] == pytest.approx(math.log1p(10)) and out[1][0] == 0


def test_age_buckets(spark):
    d = datetime(2024, 6, 15)
    df = add_temporal_features(dated(spark, [(y, d) for y in (2023, 2020, 2015, 2010, 1990)]))
    assert [r[0] for r in df.select("company_age_bucket").collect()] == ["startup", "early_growth", "established", "mature", "legacy"]


def test_bucket_edges_are_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in (0, 2, 3, 5, 6, 10, 11, 20, 21)], "a int")
    got = [r[0] for r in df.select(X.age_bucket(F.col("a"))).collect()]
    assert got == ["startup"] * 2 + ["early_growth"] * 2 + ["established"] * 2 + ["mature"] * 2 + ["legacy"]


def test_season(spark):
    df = add_temporal_features(dated(spark, [(2000, datetime(2024, m, 15)) for m in range(1, 13)]))
    rows = df.select("is_quarter_end", "is_summer", "quarter", "month_sin", "month_cos").collect()
    assert [i + 1 for i, r in enumerate(rows) if r["is_quarter_end"]] == [3, 6, 9, 12]
    assert [i + 1 for i, r in enumerate(rows) if r["is_summer"]] == [7, 8]
    assert [r["quarter"] for r in rows] == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3
    assert rows[11]["month_sin"] == pytest.approx(0, abs=1e-12) and rows[11]["month_cos"] == pytest.approx(1)


def test_temporal_fallbacks(spark):
    row = _one(add_temporal_features(spark.createDataFrame([(1,)], "company_id long")))
    assert (row["company_age_years"], row["company_age_bucket"], row["month_cos"], row["quarter"]) == (0, "unknown", 1.0, 1)


def test_industry_hierarchy(spark):
    df = spark.createDataFrame([("620100", "ZH"), ("A", "BE"), (None, None), ("", "ZH")], "industry_code_06 string, canton string")
    rows = add_company_features(df).select("noga_section", "noga_division", "noga_group", "canton_noga_section").collect()
    assert [tuple(r) for r in rows] == [
        ("6", "62", "620", "ZH_6"),
        ("A", "missing", "missing", "BE_A"),
        ("missing", "missing", "missing", "missing_missing"),
        ("missing", "missing", "missing", "ZH_missing"),
    ]


def test_flags_prefixes_logs(spark):
    df = spark.createDataFrame([("8001", 10.0, None), (None, None, -5.0)], "postal_code string, headcount double, revenue double")
    a, b = add_company_features(df).collect()
    assert (a["plz2"], a["plz3"], b["plz2"], b["plz3"]) == ("80", "800", "missing", "missing")
    assert (a["is_missing_headcount"], a["is_missing_revenue"], b["is_missing_headcount"]) == (0, 1, 1)
    assert a["headcount_log1p"] == pytest.approx(math.log(11)) and a["revenue_log1p"] == 0 and b["revenue_log1p"] == 0


def test_month_arithmetic_clamps_and_keeps_time(spark):
    row = _one(spark.range(1).select(add_months(ts_literal(datetime(2024, 3, 31, 10)), -1)))
    assert row[0] == datetime(2024, 2, 29, 10)


def test_yeo_johnson_known_points(spark):
    row = _one(
        spark.range(1).select(
            X.yeo_johnson(F.lit(3.0), 0.0), X.yeo_johnson(F.lit(3.0), 0.5), X.yeo_johnson(F.lit(-3.0), 2.0), X.yeo_johnson(F.lit(-3.0), 1.0)
        )
    )
    assert list(row) == pytest.approx([math.log(4), 2.0, -math.log(4), -3.0])


def test_hash_is_uniform_and_matches_sql(spark):
    import duckdb

    n = 50_000
    got = [r[0] for r in spark.range(n).select(hash32(F.col("id") * 1000000 + 199512, 5)).collect()]
    want = duckdb.connect().execute(f"SELECT {hash32_sql('i * 1000000 + 199512', 5)} FROM range({n}) t(i)").fetchall()
    assert sorted(got) == sorted(r[0] for r in want)
    counts = [0] * 10
    for g in got:
        counts[g * 10 // 2**32] += 1
    assert max(counts) < 1.1 * n / 10 and min(counts) > 0.9 * n / 10


def test_hash_takes_keys_beyond_32_bits(spark):
    got = [r[0] for r in spark.range(5).select(hash32(F.col("id") + 10**17)).collect()]
    assert len(set(got)) == 5 and all(0 <= g < 2**32 for g in got)


def test_role_schema_refuses_leakage_and_gaps(spark):
    df = spark.createDataFrame([(1.0, "a")], "x double, y string")
    S.RoleSchema(("x",), (), ("y",), ()).check(df)
    with pytest.raises(ValueError, match="leakage"):
        S.RoleSchema(("target",), (), (), ()).check(df)
    with pytest.raises(ValueError, match="missing"):
        S.RoleSchema(("z",), (), (), ()).check(df)
    with pytest.raises(TypeError):
        S.RoleSchema(("y",), (), (), ()).check(df)


def test_roles_contain_temporal_columns():
    r = S.RoleSchema()
    assert {"company_age_log", "month_sin", "month_cos", "is_quarter_end", "is_summer", "quarter"} <= set(r.numeric)
    assert "company_age_bucket" in r.low_card and "canton_noga_section" in r.high_card
    assert not set(r.features) & set(S.LEAKAGE)


def test_rename_master(spark):
    df = spark.createDataFrame([(7, "x", 2001, 8000, " ", "ZH ")], "id long, nm string, Gruendung_Jahr int, PLZ int, Rechtsform string, Kanton string")
    row = _one(rename_master(df, "id", "nm"))
    assert row.asDict() == {"company_id": 7, "company_name": "x", "founding_year": 2001, "postal_code": "8000", "legal_form": None, "canton": "ZH"}


MASTER = "company_id long, founding_year int, joined_at timestamp_ntz, deleted_at date"


def test_panel_rules(spark):
    s = datetime(2020, 1, 1)
    spec = PanelSpec(datetime(2021, 1, 1), (12,), 12)
    never, old = None, datetime(1888, 12, 31).date()
    rows = [
        (1, 2000, None, never),  # kept, 0
        (2, 2000, s, never),  # joins on the day: kept, 1
        (3, 2000, datetime(2020, 12, 31, 23), old),  # sentinel means alive: kept, 1
        (4, 2000, datetime(2021, 1, 1), never),  # joins when the window has closed: kept, 0
        (5, 2000, datetime(2019, 12, 31), never),  # already a member
        (6, 2021, None, never),  # not founded yet
        (7, None, None, s.date()),  # deleted by the snapshot
        (8, None, None, datetime(2020, 1, 2).date()),  # deleted later: kept
    ]
    df = spark.createDataFrame(rows, MASTER)
    got = {r["company_id"]: r["target"] for r in modeling_panel(df, spec).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 8: 0}
    assert modeling_panel(df, spec, check_alive=False).count() == 6


def test_current_prospects_use_the_strict_rule(spark):
    now = datetime(2021, 1, 1)
    df = spark.createDataFrame([(1, 2000, now, None), (2, 2000, datetime(2021, 1, 2), None), (3, 2000, None, None)], MASTER)
    assert sorted(r["company_id"] for r in current_prospects(df, PanelSpec(now)).collect()) == [2, 3]


def test_incomplete_windows_are_left_out(spark):
    df = spark.createDataFrame([(1, 2000, None, None)], MASTER)
    spec = PanelSpec(datetime(2021, 1, 1), (36, 24, 12, 6), 12)
    assert modeling_panel(df, spec).count() == 3


def test_panel_needs_no_cross_join(spark, sf):
    plan = modeling_panel(companies(spark, sf), PanelSpec(datetime(1998, 12, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "PushedFilters: [IsNotNull(o_orderpriority), IsNotNull(o_totalprice), EqualTo(o_orderpriority,1-URGENT)" in plan
