"""FIXTURES.md section 4: one tiny frame per rule."""

import pytest
from pyspark.sql import functions as F

from fillwise.config import FLAG, Params
from fillwise.operators import audit, harmonize as hz
from fillwise.operators.backtest import time_holdout
from fillwise.operators.baselines import epsr_predict
from fillwise.operators.features import add_lag_features
from fillwise.operators.flags import add_quality_flags
from fillwise.operators.intervals import add_intervals
from fillwise.operators.nowcast import lag_hier_nowcast, rps_guardrail

from frames import m, panel


def test_all_null_revenue_group_is_missing_not_zero(spark):
    rev = spark.createDataFrame([(m(1), "BU", "T", "Spotify", None), (m(1), "BU", "T", "Spotify", None)],
                                "month date, business_unit string, territory_name string, dsp string, "
                                "total_gross_amount double")
    streams = spark.createDataFrame([(m(1), "BU", "T", "Spotify", 10)],
                                    "month date, business_unit string, country string, dsp string, total_streams bigint")
    p = hz.harmonize(rev, streams, hz.label_map_frame(spark)).collect()
    assert len(p) == 1 and p[0].is_na == 1 and p[0].is_zero == 0


def test_case_sensitive_label_map(spark):
    rev = spark.createDataFrame([("TikTok",), ("Tiktok",), ("YouTube Music",)], "dsp string")
    out = dict(hz.canonicalize_dsp(rev, hz.label_map_frame(spark)).select("_raw", "dsp").collect())
    assert out == {"TikTok": "Other", "Tiktok": "TikTok", "YouTube Music": "YouTube"}


def test_null_country_goes_to_other_locations(spark):
    streams = spark.createDataFrame([(None,), ("Brazil",), ("Peru",)], "country string")
    known = spark.createDataFrame([("Brazil",)], "territory_name string")
    out = {r.country: r.territory_name for r in hz.territory_dynamic(streams, known).collect()}
    assert out == {None: "All Other Locations", "Brazil": "Brazil", "Peru": "All Other Locations"}
    static = {r.country: r.territory_name for r in hz.territory_static(streams).collect()}
    assert static["Brazil"] == "Brazil" and static["Peru"] == "All Other Locations"


def test_lag_is_previous_row_not_previous_month(spark):
    p = panel(spark, [(m(1), "B", "T", "D", 10, 5.0), (m(3), "B", "T", "D", 20, 7.0)])
    rows = add_lag_features(p).orderBy("month").collect()
    assert rows[1].gross_lag_1 == 5.0 and rows[1].streams_lag_1 == 10 and rows[1].epsr_lag_1 == 0.5


def _lagged(spark, rows):
    return add_lag_features(panel(spark, rows)).withColumn(FLAG, F.lit(0))


def test_lag_of_zero_gives_ratio_floor(spark):
    # previous revenue 0: projection 0, blend 0.8 x anchor, ratio clipped to 0.85
    w = _lagged(spark, [(m(1), "B", "T", "D", 100, 0.0), (m(2), "B", "T", "D", 100, None),
                        (m(1), "B", "T2", "D", 100, 50.0), (m(2), "B", "T2", "D", 100, 50.0)])
    train = w.where("total_gross_amount > 0")
    score = w.where("territory_name = 'T' and month = '2025-02-01'")
    r = lag_hier_nowcast(train, score, keep_parts=True).collect()[0]
    assert r.lag_proj == 0.0
    assert r.blended_pred == pytest.approx(r.anchor_pred * 0.85)


def test_missing_streams_give_zero_nowcast_and_null_rps(spark):
    w = _lagged(spark, [(m(1), "B", "T", "D", 100, 10.0), (m(2), "B", "T", "D", None, None)])
    train = w.where("total_gross_amount > 0")
    score = w.where("month = '2025-02-01'")
    r = lag_hier_nowcast(train, score).collect()[0]
    assert r.nowcast_pred == 0.0
    final = score.join(lag_hier_nowcast(train, score).select("month", "nowcast_pred"), "month")
    rps = final.select(F.when(F.col("total_streams") > 0, F.col("nowcast_pred")).alias("rps")).collect()[0].rps
    assert rps is None


def test_growth_is_clipped(spark):
    w = _lagged(spark, [(m(1), "B", "T", "D", 1, 10.0), (m(2), "B", "T", "D", 100, None),
                        (m(1), "B", "T", "E", 100, 1000.0)])
    train = w.where("total_gross_amount > 0")
    score = w.where("month = '2025-02-01'")
    r = lag_hier_nowcast(train, score, keep_parts=True).collect()[0]
    assert r.lag_proj == pytest.approx(10.0 * 1.8)


def test_scale_is_clipped(spark):
    # every blended value at 0.85 x anchor: scale would be 1/0.85 = 1.176, clipped to 1.15
    w = _lagged(spark, [(m(1), "B", "T", "D", 100, 0.0), (m(2), "B", "T", "D", 100, None),
                        (m(1), "B", "T2", "D", 100, 50.0), (m(2), "B", "T2", "D", 100, 50.0)])
    train = w.where("total_gross_amount > 0")
    score = w.where("territory_name = 'T' and month = '2025-02-01'")
    r = lag_hier_nowcast(train, score, keep_parts=True).collect()[0]
    assert r.reconcile_scale == pytest.approx(1.15)


def test_guardrail_cap(spark):
    # one dsp, RPS 1,1,1,1,100 per 1M streams: cap = max(3 x 1, 1.25 x p95)
    rows = [(m(i), "B", f"T{i}", "D", 1_000_000, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 100.0], start=1)]
    train = panel(spark, rows)
    p95 = 1.0 + 0.8 * 99.0   # pandas: position 3.8 between 1 and 100
    cap = max(3.0, 1.25 * p95)
    score = spark.createDataFrame([("D", 2_000_000, 1e9)], "dsp string, total_streams bigint, pred double")
    r = rps_guardrail(train, score, "pred").collect()[0]
    assert r.pred == pytest.approx(cap * 2.0) and r.guardrail_applied


def test_fixed_effect_needs_min_rows(spark):
    base = [(m(1 + i % 12), f"B{i}", "T", "D", 100, 10.0) for i in range(23)]
    flagged = add_quality_flags(panel(spark, base), Params(min_group_rows=24), keep_residual=True)
    assert all(abs(r._resid) < 1e-9 for r in flagged.collect())   # effects are 0 below 24 rows


def test_no_known_rows_no_flags(spark):
    p = panel(spark, [(m(1), "B", "T", "D", 100, None), (m(2), "B", "T", "D", 100, 0.0)])
    assert [r[FLAG] for r in add_quality_flags(p).collect()] == [0, 0]


def test_flags_invariant_under_shuffled_input(spark, tmp_path):
    rows = [(m(1 + i % 12), f"B{i}", f"T{i % 3}", f"D{i % 4}", 100 + i, float(10 + (i * 37) % 90))
            for i in range(200)]
    a = {tuple(r[:4]): r[FLAG] for r in add_quality_flags(panel(spark, rows)).collect()}
    b = {tuple(r[:4]): r[FLAG] for r in add_quality_flags(panel(spark, list(reversed(rows))).repartition(5)).collect()}
    assert a == b and sum(a.values()) > 0


def test_interval_group_fallback(spark):
    cal = spark.createDataFrame([("X", 100.0, 100.0 + i) for i in range(29)] + [("Y", 100.0, 100.0 + 2 * i) for i in range(30)],
                                "dsp string, pred double, total_gross_amount double")
    pred = spark.createDataFrame([("X", 10.0), ("Y", 10.0)], "dsp string, nowcast_pred double")
    out = {r.dsp: r for r in add_intervals(pred, cal, "nowcast_pred", "pred").collect()}
    import pandas as pd
    e_all = pd.Series([i / 100 for i in range(29)] + [2 * i / 100 for i in range(30)])
    e_y = pd.Series([2 * i / 100 for i in range(30)])
    assert out["X"].nowcast_upper_90 == pytest.approx(10 * (1 + e_all.quantile(0.9)))   # 29 rows: global q
    assert out["Y"].nowcast_upper_90 == pytest.approx(10 * (1 + e_y.quantile(0.9)))     # 30 rows: group q


def test_mad_of_zero_gives_null_z(spark):
    f = spark.createDataFrame([(5.0, 100.0, 100)] * 4, "rps double, filled_revenue double, total_streams bigint")
    z = audit.robust_z(f).collect()
    assert all(r.robust_z_all is None for r in z)
    assert audit.suspicious_rows(f).count() == 0


def test_zero_wmape_denominator_is_null(spark):
    from fillwise.operators.backtest import method_metrics
    preds = spark.createDataFrame([("M", 0.0, 1.0), ("M", 0.0, 2.0)], "model string, total_gross_amount double, pred double")
    assert method_metrics(preds).collect()[0].wmape is None


def test_epsr_fallback_chain(spark):
    train = panel(spark, [(m(1), "B1", "T1", "D1", 100, 100.0),   # cohort rate 1.0
                          (m(1), "B2", "T1", "D1", 100, 300.0),   # td rate (100+300)/200 = 2.0
                          (m(1), "B3", "T2", "D1", 100, 600.0),   # dsp rate (100+300+600)/300
                          (m(1), "B4", "T3", "D2", 100, 1000.0)])
    score = panel(spark, [(m(2), "B1", "T1", "D1", 10, None), (m(2), "B9", "T1", "D1", 10, None),
                          (m(2), "B9", "T9", "D1", 10, None), (m(2), "B9", "T9", "D9", 10, None)])
    got = {(r.business_unit, r.territory_name, r.dsp): r.pred for r in epsr_predict(train, score).collect()}
    assert got[("B1", "T1", "D1")] == pytest.approx(10 * 1.0)
    assert got[("B9", "T1", "D1")] == pytest.approx(10 * 2.0)
    assert got[("B9", "T9", "D1")] == pytest.approx(10 * 1000 / 300)
    assert got[("B9", "T9", "D9")] == pytest.approx(10 * 2000 / 400)


def test_single_month_holdout_falls_back_to_80_20(spark):
    p = panel(spark, [(m(1), f"B{i}", "T", "D", 100, 1.0) for i in range(200)])
    train, val = time_holdout(p)
    assert train.count() + val.count() == 200 and 15 <= val.count() <= 70


def test_all_actual_month_has_zero_width(spark):
    f = spark.createDataFrame([(m(1), "D", 100, 10.0, None, None, "actual")],
                              "month date, dsp string, total_streams bigint, filled_revenue double, "
                              "nowcast_lower_90 double, nowcast_upper_90 double, value_status string")
    r = audit.dsp_month_reliability(f).collect()[0]
    assert r.revenue_lower == 0.0 and r.revenue_upper == 0.0 and r.uncertainty_width_pct == -100.0 + 100.0


def test_replace_by_key_is_idempotent(spark):
    from fillwise.functions.tables import replace_by_key
    t = spark.createDataFrame([("EPSR", 0.2), ("Naive", 0.3)], "model string, wmape double")
    new = spark.createDataFrame([("EPSR", 0.1)], "model string, wmape double")
    once = replace_by_key(t, new, ["model"])
    twice = replace_by_key(once, new, ["model"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [("EPSR", 0.1), ("Naive", 0.3)]


def test_a_tiny_line_survives_the_money_sum(spark):
    from fillwise.functions.money import money_sum
    df = spark.createDataFrame([(1e-7,), (None,), (2.5,)], "x double")
    assert df.where("x < 1").agg(money_sum("x")).collect()[0][0] == 1e-7
    assert df.agg(money_sum("x")).collect()[0][0] == 2.5000001


def test_sql_harmonization_keeps_null_keys_apart(spark):
    from fillwise.operators.harmonize import harmonize, label_map_frame
    from fillwise.plans.sql_harmonize import harmonize_sql
    rev = spark.createDataFrame([("2024-01-01", None, "Brazil", "Spotify", 5.0), ("2024-01-01", "A", "Brazil", "Spotify", 0.0),
                                 ("2024-01-01", "A", "Brazil", "x", None)],
                                "month string, business_unit string, territory_name string, dsp string, total_gross_amount double")
    plays = spark.createDataFrame([("2024-01-01", None, "Brazil", "Spotify", 10), ("2024-01-01", "A", "Brazil", "Spotify", 7),
                                   ("2024-01-01", "A", "Peru", "Spotify", 3)],
                                  "month string, business_unit string, country string, dsp string, total_streams long")
    m = label_map_frame(spark)
    key = lambda r: tuple(str(v) for v in r)
    by_sql, by_plan = harmonize_sql(spark, rev, plays, m), harmonize(rev, plays, m)
    got = sorted(map(key, by_sql.collect()))
    assert got == sorted(map(key, by_plan.select(*by_sql.columns).collect())) and len(got) == 5
