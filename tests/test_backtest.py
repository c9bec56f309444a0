from pyspark.sql import functions as F

from fillwise.operators.backtest import REPEAT
from fillwise.plans.context import context

SF = "/root/testdata/sf0.001"


def test_plan_allocates_exactly_the_holdout_size(spark):
    plan = context(spark, SF).holdout_plan().collect()
    sizes = {r.holdout_size for r in plan}
    assert len(sizes) == 1 and sum(r.holdout_rows for r in plan) == sizes.pop()
    assert abs(sum(r.share for r in plan) - 1.0) < 1e-12


def test_holdout_counts_follow_the_plan(spark):
    ctx = context(spark, SF)
    pool, _ = ctx.pools()
    plan = {r.month: r.holdout_rows for r in ctx.holdout_plan().collect()}
    avail = {r.month: r["count"] for r in pool.groupBy("month").count().collect()}
    train, test = ctx.split()
    got = {(r[REPEAT], r.month): r["count"] for r in test.groupBy(REPEAT, "month").count().collect()}
    for (rep, month), n in got.items():
        assert n == min(plan[month], avail[month])
    assert {rep for rep, _ in got} == set(range(1, ctx.params.n_repeats + 1))
    # train and test partition the repeated pool
    assert train.count() + test.count() == pool.count() * ctx.params.n_repeats
    assert train.join(test, [REPEAT, "month", "business_unit", "territory_name", "dsp"]).count() == 0


def test_repeats_differ(spark):
    ctx = context(spark, SF)
    _, test = ctx.split()
    per = test.groupBy(REPEAT).agg(F.sort_array(F.collect_list(F.concat_ws("|", "month", "business_unit",
                                                                          "territory_name", "dsp"))).alias("k"))
    keys = [tuple(r.k) for r in per.collect()]
    assert len(set(keys)) > 1


def test_held_out_rows_equal_the_ranked_ones(spark):
    ctx = context(spark, SF)
    keys = [REPEAT, "month", "business_unit", "territory_name", "dsp"]
    _, test = ctx.split()
    want = {tuple(r) for r in test.select(keys).collect()}
    got = [tuple(r) for r in ctx.held().select(keys).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_margin_that_misses_is_widened(spark, monkeypatch):
    from fillwise.operators import backtest as bt
    ctx = context(spark, SF)
    monkeypatch.setattr(bt, "MARGIN", 0.05)
    assert bt.held_out_rows(ctx.pool(), ctx.holdout_plan(), ctx.params).exceptAll(ctx.held()).count() == 0


def test_subtraction_equals_fits_on_copies(spark):
    from fillwise.operators.backtest import backtest_predictions
    ctx = context(spark, SF)
    keys = ["model", REPEAT, "month", "business_unit", "territory_name", "dsp"]
    want = {tuple(r[k] for k in keys): r.pred for r in backtest_predictions(*ctx.split(), ctx.params).collect()}
    got = {tuple(r[k] for k in keys): r.pred for r in ctx.predictions().collect()}
    assert got.keys() == want.keys()
    for k, p in want.items():
        assert (p is None) == (got[k] is None) and (p is None or abs(p - got[k]) <= 1e-9 * max(1, abs(p)))
