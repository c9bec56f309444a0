"""Joint boosted trees against a plain version that grows one fit's trees leaf by leaf."""
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillwise.config import COHORT
from fillwise.operators import forest, ml
from fillwise.operators.features import add_lag_features
from fillwise.operators.forest import FIRST_LAG, LEAVES, LEVELS, ONE, Grid, Rule, predict
from fillwise.operators.held_models import NUMBERS, _numbers
from fillwise.session import cut_lineage

from frames import m, panel

KEY = ["month", "business_unit", "territory_name", "dsp"]
MEDIANS = {1: dict(zip(ml.LAGS, (200.0, 9_000.0, 0.01))), 2: dict(zip(ml.LAGS, (350.0, 20_000.0, 0.02))), 3: {}}


@pytest.fixture(scope="module")
def pool(spark):
    """Lag gaps, a hot level, equal points; fit 1 leaves a seventh out, fit 2 a third, fit 3 everything."""
    rng = np.random.default_rng(8)
    rows = {}
    for i in range(900):
        streams = int(rng.integers(1_000, 50_000)) if i % 5 else 7_000
        key = (m(1 + i % 12), f"B{i % 3}", f"T{i % 25}", f"D{(i // 12) % 25 // 20}")
        rows[key] = (*key, streams, float(np.round(streams * 0.01 * (1 + i % 3) + abs(rng.normal(scale=30)), 4)))
    rows = add_lag_features(panel(spark, list(rows.values())))
    mix = F.pmod(F.xxhash64(*KEY), F.lit(21))
    out = F.array_compact(F.array(F.when(mix < 3, 1), F.when(mix % 3 == 1, 2), F.lit(3)))
    return cut_lineage(rows.select(*KEY, "total_streams", "total_gross_amount", *ml.LAGS, out.alias("out")))


def _best(codes, rest, grid, allowed, rule):
    """The best split of given rows, found by trying every one."""
    starts = grid.starts

    def best(rows):
        found = None
        for cell in np.flatnonzero(allowed):
            c = int(np.searchsorted(starts, cell, "right")) - 1
            v, b = codes[rows, c], cell - starts[c]
            right = v == b if c < len(COHORT) else v > b
            if min(right.sum(), (~right).sum()) < rule.least:
                continue

            def score(mask):
                t = rest[rows][mask].sum() / ONE
                return max(abs(t) - rule.l1, 0) ** 2 / (mask.sum() + rule.l2)
            gain = score(~right) + score(right) - score(np.ones(len(rows), bool))
            if gain > 1e-9 and (found is None or gain > found[0] + 1e-12):
                found = (gain, c, b)
        return found

    return best


def _plain(frame, grid, medians, rule, fit):
    """Predictions of one fit for all rows, by trying every split of every leaf."""
    n = len(frame)
    codes = np.zeros((n, len(forest.COLUMNS)), int)
    for c, name in enumerate(COHORT):
        codes[:, c] = [grid.levels[c].index(v) if v in grid.levels[c] else len(grid.levels[c]) for v in frame[name]]
    for j, name in enumerate((*NUMBERS, *ml.LAGS)):
        v = frame[f"_{name}"].to_numpy(float).copy()
        if len(COHORT) + j >= FIRST_LAG and medians.get(name) is not None:
            v[np.isnan(v)] = medians[name]
        codes[:, len(COHORT) + j] = grid.code(len(COHORT) + j, v)
    y = np.round(np.log1p(frame["total_gross_amount"].to_numpy(float)) * ONE)
    train = np.array([fit not in o for o in frame["out"]])
    now = np.full(n, np.round(y[train].mean()))
    key = frame["key"].to_numpy(np.int64).view(np.uint64)
    sizes = []
    for turn in range(rule.rounds):
        rest = y - now
        use = train & forest._drawn(key, rule, turn)
        best = _best(codes, rest, grid, grid.choice(rule, turn), rule)
        leaves = [(np.ones(n, bool), 0)]
        splits = {0: best(np.flatnonzero(use))}
        while True:
            able = [i for i, s in splits.items() if s and (rule.depth is None or leaves[i][1] < rule.depth)]
            if not able or (rule.leaves and sum(i in splits for i in range(len(leaves))) == rule.leaves):
                break
            i = max(able, key=lambda i: splits[i][0])
            _, c, b = splits.pop(i)
            mask, depth = leaves[i]
            right = codes[:, c] == b if c < len(COHORT) else codes[:, c] > b
            for side in (mask & ~right, mask & right):
                leaves.append((side, depth + 1))
                splits[len(leaves) - 1] = best(np.flatnonzero(side & use))
        sizes.append([int((leaves[i][0] & use).sum()) for i in splits])
        for i in splits:
            mask = leaves[i][0]
            t, k = rest[mask & use].sum() / ONE, (mask & use).sum()
            now[mask] += np.round(rule.rate * np.sign(t) * max(abs(t) - rule.l1, 0) / (k + rule.l2) * ONE)
    return np.maximum(np.expm1(now / ONE), 0), sizes


@pytest.mark.parametrize("rule", [replace(LEAVES, rounds=3), replace(LEVELS, rounds=3, rows=0.8),
                                  replace(LEAVES, leaves=5, rounds=2)], ids=["leaves", "levels", "five"])
def test_joint_trees_equal_plain_ones(spark, pool, rule, monkeypatch):
    monkeypatch.setattr(forest, "KEEP", 2)
    got = {(r.fit, *[str(r[c]) for c in KEY]): r.pred for r in predict(pool.repartition(5), [1, 2, 3], MEDIANS, rule, "out", KEY).collect()}
    some = pool.where(F.size(F.array_intersect("out", F.array(F.lit(1), F.lit(2), F.lit(3)))) < 3)
    grid = Grid.of(some)
    frame = pool.select("*", *[c.alias(f"_{n}") for n, c in _numbers().items()], F.xxhash64(*KEY).alias("key")).toPandas()
    seen = 0
    for fit in (1, 2):
        want, sizes = _plain(frame, grid, MEDIANS[fit], rule, fit)
        assert all(min(s) >= rule.least for s in sizes)
        assert all(len(s) <= (rule.leaves or 2 ** rule.depth) for s in sizes) and max(len(s) for s in sizes) > 4
        for i, o in enumerate(frame["out"]):
            if fit in o:
                assert got[(fit, *[str(frame[c][i]) for c in KEY])] == pytest.approx(want[i], rel=1e-9)
                seen += 1
    assert seen > 100
    assert all(v is None for k, v in got.items() if k[0] == 3)  # nothing to train on


@pytest.mark.parametrize("rule", [replace(LEAVES, rounds=4), replace(LEVELS, rounds=4)], ids=["leaves", "levels"])
def test_fits_alone_and_partitions_change_nothing(pool, rule):
    grid = Grid.of(pool)
    both = {tuple(r) for r in predict(pool.repartition(7), [1, 2], MEDIANS, rule, "out", KEY, grid=grid).collect()}
    one = {tuple(r) for f in (1, 2) for r in predict(pool.coalesce(1), [f], MEDIANS, rule, "out", KEY, grid=grid).collect()}
    assert both == one and len(both) > 100


def test_empty_table_nulls_and_more_rounds_fit_better(pool):
    assert predict(pool.limit(0), [1], {}, replace(LEAVES, rounds=2), "out", KEY).count() == 0
    holes = pool.select(*KEY[:3], F.lit(None).cast("string").alias("dsp"), F.lit(None).cast("bigint").alias("total_streams"),
                        F.when(F.col("dsp") != "D0", F.col("total_gross_amount")).alias("total_gross_amount"), *ml.LAGS, "out")
    assert all(r.pred >= 0 for r in predict(holes, [1], MEDIANS, replace(LEAVES, rounds=2), "out", KEY).collect())

    def error(rounds):
        got = predict(pool, [1], MEDIANS, replace(LEAVES, rounds=rounds), "out", [*KEY, "total_gross_amount"])
        return got.agg(F.avg(F.abs(F.col("pred") - F.col("total_gross_amount")))).first()[0]
    assert error(30) < error(1)


def test_rule_of_the_models():
    assert (LEAVES.leaves, LEAVES.least, LEAVES.rounds, LEVELS.depth, LEVELS.least) == (24, 30, 350, 4, 6)
    assert isinstance(LEVELS, Rule)


def test_repeats_and_one_train_set(pool):
    """The two entry points: held-out rows of repeats, and a train and a score table."""
    rule = replace(LEAVES, rounds=3)
    held = pool.where(F.array_contains("out", 1)).withColumn("repeat", F.lit(1)).unionByName(
        pool.where(F.array_contains("out", 2)).withColumn("repeat", F.lit(2)))
    got = forest.held_predictions(pool, held, "repeat", MEDIANS, 2, rule).collect()
    both = predict(pool.withColumn("out", F.array_intersect("out", F.array(F.lit(1), F.lit(2)))), [1, 2], MEDIANS, rule, "out",
                   [*KEY, "total_gross_amount"], "repeat").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in both} and len(got) == held.count()
    train, score = pool.where(~F.array_contains("out", 1)), pool.where(F.array_contains("out", 1))
    one = forest.fit_predict_trees(train, score, rule)
    assert one.columns == [*KEY, "total_gross_amount", "pred"]
    assert one.where("pred >= 0").count() == score.count()
