"""Properties from the survey's test strategy, on random small inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fillwise.config import FLAG
from fillwise.operators import harmonize as hz
from fillwise.operators.features import add_lag_features
from fillwise.operators.nowcast import lag_hier_nowcast

from frames import panel

LABELS = ["Spotify", "Tiktok", "Amazon Prime", "Unknown Label"]
PLACES = ["Brazil", "Canada", "Peru", None]

rev_rows = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["BU1", "BU2"]), st.sampled_from(PLACES[:3]),
                              st.sampled_from(LABELS),
                              st.one_of(st.none(), st.integers(0, 10_000).map(lambda c: c / 100))),
                    min_size=1, max_size=25)
str_rows = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["BU1", "BU2"]), st.sampled_from(PLACES),
                              st.sampled_from(["Spotify", "TikTok", "Amazon", "Other"]), st.integers(1, 10_000)),
                    min_size=1, max_size=25)


@settings(max_examples=6, deadline=None)
@given(rev_rows, str_rows)
def test_full_outer_join_preserves_totals(spark, revs, strs):
    d = lambda m: dt.date(2025, m, 1)
    revenue = spark.createDataFrame([(d(m), b, t, lab, v) for m, b, t, lab, v in revs],
                                    "month date, business_unit string, territory_name string, dsp string, "
                                    "total_gross_amount double")
    streams = spark.createDataFrame([(d(m), b, c, f, s) for m, b, c, f, s in strs],
                                    "month date, business_unit string, country string, dsp string, "
                                    "total_streams bigint")
    p = hz.harmonize(revenue, streams, hz.label_map_frame(spark))
    got = p.agg(F.sum("total_gross_amount").alias("r"), F.sum("total_streams").alias("s")).collect()[0]
    want_r = sum(v for *_, v in revs if v is not None)
    assert (got.r or 0.0) == round(want_r, 6) or abs((got.r or 0.0) - want_r) < 1e-6
    assert got.s == sum(s for *_, s in strs)
    assert hz.duplicate_keys(p).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from(["B1", "B2"]), st.sampled_from(["T1", "T2"]),
                          st.sampled_from(["D1", "D2"]), st.integers(1, 5_000),
                          st.one_of(st.none(), st.integers(0, 50_000).map(float))),
                min_size=2, max_size=30, unique_by=lambda r: r[:4]))
def test_blend_ratio_bounded_before_scaling(spark, rows):
    p = panel(spark, [(dt.date(2025, m, 1), b, t, d, s, v) for m, b, t, d, s, v in rows])
    w = add_lag_features(p).withColumn(FLAG, F.lit(0))
    train = w.where("is_na = 0 AND is_zero = 0 AND total_streams > 0")
    score = w.where("is_na = 1 OR is_zero = 1")
    if train.count() == 0 or score.count() == 0:
        return
    out = lag_hier_nowcast(train, score, keep_parts=True).collect()
    for r in out:
        assert r.nowcast_pred >= 0.0
        if r.anchor_pred > 0:
            ratio = r.blended_pred / r.anchor_pred
            assert 0.85 - 1e-12 <= ratio <= 1.15 + 1e-12
            assert 0.85 - 1e-12 <= r.reconcile_scale <= 1.15 + 1e-12
