import numpy as np
import pytest

from fillwise.operators import ml

from frames import m, panel


def _frames(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        streams = int(rng.integers(1_000, 50_000))
        rows.append((m(1 + i % 12), f"B{i % 3}", f"T{i % 4}", f"D{i % 2}", streams,
                     float(np.round(streams * 0.01 + rng.normal(scale=20), 4))))
    p = panel(spark, rows)
    from fillwise.operators.features import add_lag_features
    w = add_lag_features(p)
    return w.where("month_num < 12"), w.where("month_num = 12")


KEY = ["month", "business_unit", "territory_name", "dsp"]


def _design(spark, train, score):
    tr, sc = ml._encode_linear(*ml._features(train, score), ml.LINEAR_NUMERIC)
    trows = tr.select("features", "total_gross_amount").collect()
    x = np.array([r.features.toArray() for r in trows])
    y = np.array([r.total_gross_amount for r in trows])
    srows = sorted(sc.select(*KEY, "features").collect(), key=lambda r: tuple(r[:4]))
    xs = np.array([r.features.toArray() for r in srows])
    return x, y, xs


def _preds(df):
    return np.array([r.pred for r in sorted(df.select(*KEY, "pred").collect(), key=lambda r: tuple(r[:4]))])


def test_ols_matches_closed_form(spark):
    train, score = _frames(spark)
    x, y, xs = _design(spark, train, score)
    coef, *_ = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)
    expect = np.clip(np.c_[np.ones(len(xs)), xs] @ coef, 0, None)
    got = _preds(ml.fit_predict_linear(train, score))
    assert got == pytest.approx(expect, rel=1e-6, abs=1e-6)


def test_ridge_matches_closed_form(spark):
    train, score = _frames(spark)
    x, y, xs = _design(spark, train, score)
    xm, ym = x.mean(axis=0), y.mean()
    w = np.linalg.solve((x - xm).T @ (x - xm) + 10.0 * np.eye(x.shape[1]), (x - xm).T @ (y - ym))
    expect = np.clip(xs @ w + (ym - xm @ w), 0, None)
    got = _preds(ml.fit_predict_linear(train, score, alpha=10.0))
    assert got == pytest.approx(expect, rel=1e-4, abs=1e-4)


def test_gbt_plumbing(spark):
    train, score = _frames(spark)
    out = ml.fit_predict_gbt(train, score, rounds=5)
    preds = _preds(out)
    assert len(preds) == score.count() and (preds >= 0).all()


def _tree_tasks(spark, train, score, group):
    """Predictions of a short tree fit and the task counts of its stages that grow trees."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    preds = _preds(ml.fit_predict_gbt(train, score, rounds=3))
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return preds, [s.numTasks for s in stages if s and "RandomForest.scala" in s.name]


def test_tree_fit_has_tasks_by_rows_not_by_parts_of_its_input(spark, monkeypatch):
    train, score = _frames(spark)
    preds, tasks = _tree_tasks(spark, train.repartition(8), score, "few-rows")
    assert len(preds) == score.count() and tasks and set(tasks) == {1}
    n = train.count()
    monkeypatch.setattr(ml, "FIT_ROWS", -(-n // 3))
    preds, tasks = _tree_tasks(spark, train.coalesce(1), score, "more-rows")
    assert len(preds) == score.count() and max(tasks) == 3


def test_tree_fit_reads_encoded_rows_from_a_table(spark):
    train, score = _frames(spark)
    tr, _ = ml._features(train, score)
    encoded = ml._tree_encoder(ml.TREE_NUMERIC).fit(tr).transform(tr).withColumnRenamed("total_gross_amount", "_y")
    rows = ml._fit_rows(encoded, "_y")
    assert "UDF" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, encoded.select("features", "_y").collect()))


def test_all_repeats_in_one_job_match_single_fits(spark):
    from fillwise.plans.context import context
    ctx = context(spark, "/root/testdata/sf0.001")
    train, test = ctx.split()
    keys = ["repeat", "month", "business_unit", "territory_name", "dsp"]
    for alpha, tol in ((None, 1e-4), (10.0, 1e-8)):
        many = ml.fit_predict_linear_by(train, test, ["repeat"], alpha=alpha).where("repeat = 5")
        one = ml.fit_predict_linear(train.where("repeat = 5"), test.where("repeat = 5"), alpha=alpha)
        j = many.select(*keys, "pred").join(one.select(*keys, one.pred.alias("p1")), keys).collect()
        assert len(j) == test.where("repeat = 5").count() > 0
        for r in j:
            assert abs(r.pred - r.p1) <= tol * max(abs(r.p1), 1.0)


def test_knn_is_exact_against_brute_force(spark):
    from pyspark.ml.functions import vector_to_array

    from fillwise.operators.knn import fit_predict_knn
    from fillwise.plans.catalog import _holdout
    from fillwise.plans.context import context
    train, val = _holdout(context(spark, "/root/testdata/sf0.001"))
    rep = {}
    got = {tuple(r[:4]): r.pred for r in fit_predict_knn(train, val, report=rep)
           .select(*KEY, "pred").collect()}
    tr, sc = ml._features(train, val)
    enc = ml._tree_encoder(ml.TREE_NUMERIC).fit(tr)
    t = enc.transform(tr).select(vector_to_array("features").alias("x"), "total_gross_amount").collect()
    s = enc.transform(sc).select(*KEY, vector_to_array("features").alias("x")).collect()
    x = np.array([r.x for r in t])
    y = np.array([r.total_gross_amount for r in t], dtype=float)
    mu, sd = x.mean(0), x.std(0)
    sd[sd == 0] = 1
    xs = (x - mu) / sd
    assert rep["pairs_compared"] <= rep["all_pairs"]
    for r in s:
        q = (np.array(r.x) - mu) / sd
        d = np.sqrt(((xs - q) ** 2).sum(1))
        idx = np.argsort(d, kind="stable")[:21]
        dk = d[idx]
        want = y[idx][dk == 0].mean() if (dk == 0).any() else (y[idx] / dk).sum() / (1 / dk).sum()
        assert got[tuple(r[:4])] == pytest.approx(max(want, 0.0), rel=1e-9, abs=1e-6)


def test_knn_tasks_hold_no_pairs_of_pivots(spark, monkeypatch):
    from fillwise.operators.knn import fit_predict_knn
    from fillwise.plans.catalog import _holdout
    from fillwise.plans.context import context
    frame, shapes = type(spark.range(0)), []

    def map_in_arrow(self, func, *a, work=frame.mapInArrow, **b):
        shapes.extend(c.cell_contents.shape for c in func.__closure__ or () if isinstance(c.cell_contents, np.ndarray))
        return work(self, func, *a, **b)

    monkeypatch.setattr(frame, "mapInArrow", map_in_arrow)
    fit_predict_knn(*_holdout(context(spark, "/root/testdata/sf0.001")))
    assert max(len(s) for s in shapes) == 2
    assert not [s for s in shapes if len(s) == 2 and s[0] == s[1]]
