"""Models of all repeats by subtraction against separate fits on each repeat's train rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from fillwise.operators import ml
from fillwise.operators.features import add_lag_features
from fillwise.operators.held_models import fit_pool, predict_linear, residuals
from fillwise.operators.knn import fit_predict_knn
from fillwise.operators.knn_held import predict_knn
from fillwise.session import cut_lineage

from frames import m, panel

KEY = ["month", "business_unit", "territory_name", "dsp"]
N = 4


@pytest.fixture(scope="module")
def split(spark):
    """A pool with lag gaps, a level that repeat 2 holds out whole, repeat 3 with equal points,
    and repeat 4 that holds out nothing."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        streams = int(rng.integers(1_000, 50_000)) if i % 5 else 7_000
        rows.append((m(1 + (i // 25) % 12), f"B{i % 3}", f"T{i % 5}", f"D{i % 25 // 15}" if i != 77 else "Rare", streams,
                     float(np.round(streams * 0.01 + rng.normal(scale=20), 4))))
    rows = list({r[:4]: r for r in rows}.values())
    pool = add_lag_features(panel(spark, rows)).select(*KEY, "total_streams", "total_gross_amount", *ml.LAGS)
    pool = cut_lineage(pool)
    mix = F.pmod(F.xxhash64(*KEY), F.lit(7))
    held = pool.where(mix == 1).withColumn("repeat", F.lit(1)).unionByName(
        pool.where((mix == 2) | (F.col("dsp") == "Rare")).withColumn("repeat", F.lit(2))).unionByName(
        pool.where(mix.isin(3, 4, 5)).withColumn("repeat", F.lit(3)))
    copies = lambda df: df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(N))))
    return pool, held, fit_pool(pool, held, "repeat", N, copies)


def _train_test(pool, held, r):
    test = held.where(F.col("repeat") == r).drop("repeat")
    return pool.join(test.select(*KEY), KEY, "left_anti"), test


def _by_key(df):
    return {tuple(str(r[c]) for c in KEY): r.pred for r in df.select(*KEY, "pred").collect()}


@pytest.fixture(scope="module")
def neighbours(split):
    pool, held, fits = split
    return cut_lineage(predict_knn(fits, pool, held, "repeat", k=5))


@pytest.mark.parametrize("r", [1, 2, 3])
def test_knn_of_all_repeats_equals_a_search_per_repeat(split, neighbours, r):
    pool, held, _ = split
    train, test = _train_test(pool, held, r)
    want = _by_key(fit_predict_knn(train, test, k=5))
    got = _by_key(neighbours.where(F.col("repeat") == r))
    assert got.keys() == want.keys() and len(want) > 10
    for key, pred in want.items():
        assert got[key] == pytest.approx(pred, rel=1e-9)


@pytest.mark.parametrize("r", [1, 2, 3])
@pytest.mark.parametrize("alpha", [None, 10.0])
def test_linear_of_all_repeats_equals_closed_forms(split, r, alpha):
    pool, held, fits = split
    train, test = _train_test(pool, held, r)
    design = fits.design
    fill = design.filled(fits.medians[r])[design.linear]

    def rows(df):
        got = df.select(*KEY, design.vector().alias("z")).collect()
        z = np.array([x.z for x in got])
        return [tuple(str(x[c]) for c in KEY) for x in got], z @ fill.T, z[:, -1]
    _, x, y = rows(train)
    keys, xs, _ = rows(test)
    med = {c: float(np.median([v for v in (q[c] for q in train.select(c).collect()) if v is not None])) for c in ml.LAGS}
    assert fits.medians[r] == pytest.approx(med)
    mean = x.mean(0)
    if alpha is None:
        w = np.linalg.lstsq(x - mean, y - y.mean(), rcond=None)[0]
    else:
        w = np.linalg.solve((x - mean).T @ (x - mean) + alpha * np.eye(x.shape[1]), (x - mean).T @ (y - y.mean()))
    want = dict(zip(keys, np.clip((xs - mean) @ w + y.mean(), 0, None)))
    got = _by_key(predict_linear(fits, held, "repeat", {"model": alpha}).where(F.col("repeat") == r))
    assert got.keys() == want.keys()
    for key, pred in want.items():
        assert got[key] == pytest.approx(pred, rel=1e-6, abs=1e-6)


def test_empty_pool_and_repeat_without_train_rows(split):
    pool, _, _ = split
    copies = lambda df: df.withColumn("repeat", F.lit(1))
    small = pool.limit(3)
    held = small.withColumn("repeat", F.lit(1))
    for rows, gone in ((pool.limit(0), held.limit(0)), (small, held)):
        fits = fit_pool(rows, gone, "repeat", 1, copies)
        for got in (predict_linear(fits, gone, "repeat", {"a": None, "b": 1.0}), predict_knn(fits, rows, gone, "repeat")):
            assert all(x.pred is None for x in got.collect())


def test_normal_equations_hold(split):
    pool, _, _ = split
    got = residuals(pool, {"a": None, "b": 10.0}).collect()
    assert {r.model for r in got} == {"a", "b"}
    assert max(r.residual for r in got) < 1e-8
