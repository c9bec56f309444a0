"""KNN (M7) on every backtest repeat's held-out rows, from one placing of the pool (B1).

Each repeat has its own train rows, lag medians and scales, hence its own distance. The pool is
not copied: a point lies once in its pivot's cell, with the repeats that hold it out, and a
query (repeat, row) meets cells. A repeat's distance is a linear map of the row vector ``z``
(``fillwise.operators.held_models``), applied in the task that compares.

Cells are cut in the whole pool's distance D. For a train point p of repeat r and a query q,

    D_r(p, q) >= ratio_r * sqrt(max(0, D(p, q)^2 - lone_q)) - moved_r

where ``ratio_r`` is the least quotient of r's and the pool's weight of a feature, ``moved_r`` how
far r's medians lie from the pool's in r's scale, and ``lone_q`` the part of D that comes from
levels that no train row of r has (r gives them no weight, as an encoder fitted on its train
rows has no such column). Phase 1 meets the nearest cells that together hold k train points
of r; the k-th distance there bounds the search, and phase 2 meets every other cell whose lower
bound, by pivot, radius and the border to the query's nearest pivot, is within it. The result equals a separate
search per repeat (tested). Ties at the k-th distance go to the smaller key.

Pivots number about the root of the pool's rows, by a threshold on the uniform row key.
Points and queries of a cell meet in blocks of bounded size, compared by a matrix product with
slack and then exactly; a block returns at most k rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, MONTH, TARGET
from fillwise.functions.joins import lookup_join
from fillwise.functions.safe import non_negative
from fillwise.operators.held_models import FLAT, LAGS, HeldFits, matrix
from fillwise.operators.knn import POINT_ROWS, QUERY_ROWS, grain_key, neighbour_mean
from fillwise.session import cut_lineage, ship

#: Keys are below this; a task's (query, pivot) and (query, point) tables hold about this many numbers.
KEYS = 1 << 60
TABLE = 1 << 18


class Metrics:
    """Per repeat (0: the pool) the map from ``z`` to scaled features, and the bound's constants."""

    def __init__(self, fits: HeldFits):
        design, repeats = fits.design, sorted(fits.train)
        own = [fits.medians[r] for r in repeats if r in fits.medians]
        middle = {c: float(np.mean([m[c] for m in own if m.get(c) is not None] or [fits.design.shift[c]])) for c in LAGS}
        medians = {r: {c: fits.medians.get(r, {}).get(c, middle[c] if r == 0 else None) for c in LAGS} for r in repeats}
        hot = len(design.levels)
        self.maps, weights = {}, {}
        for r in repeats:
            fill, gram = design.filled(medians[r]), fits.train[r]
            n = max(gram[0, 0], 1.0)
            mean, square = fill @ gram[:, 0] / n, np.einsum("ij,jk,ik->i", fill, gram, fill) / n
            var = square - mean**2
            w = np.where(var > FLAT * square, 1 / np.sqrt(np.where(var > FLAT * square, var, 1.0)), 1.0)
            w[:hot][gram[0, 1:hot + 1] == 0] = 0.0  # the level is in no train row
            self.maps[r], weights[r] = w[:, None] * fill, w
        self.ratio, self.moved, self.lone = {}, {}, {}
        for r in repeats:
            on = (weights[r] > 0) & (weights[0] > 0)
            self.ratio[r] = float((weights[r][on] / weights[0][on]).min()) if on.any() else 0.0
            shift = [(medians[r][c] if medians[r][c] is not None else design.shift[c]) - middle[c] for c in LAGS]
            self.moved[r] = float(np.linalg.norm(weights[r][-len(LAGS):] * shift))
            self.lone[r] = weights[r] == 0


def _root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(x, 0.0))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` and ``b``, exact for equal rows."""
    out = np.empty((len(a), len(b)))
    for j in range(len(b)):
        out[:, j] = np.sqrt(((a - b[j]) ** 2).sum(1))
    return out


def _arrays(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows, dtype=np.float64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))


def _met(queries: DataFrame, points: DataFrame, metrics: Metrics, k: int) -> DataFrame:
    """(repeat, qid, dist, tid, y): per block the k nearest train points within ``limit``."""
    def blocks(df: DataFrame, own: str, rows: int) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(own))

    plan = cut_lineage(blocks(points, "ps", POINT_ROWS).join(blocks(queries, "qs", QUERY_ROWS), "cell"))

    def dealt(df: DataFrame, key: list[str], own: str, other: str) -> DataFrame:
        return (df.join(plan, "cell").withColumn(own, F.pmod(F.xxhash64(*key), F.col(own + "s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1))).drop("ps", "qs"))

    def nearest(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(p) and len(q):
            z, tid, y = np.stack(p["z"]), p["tid"].to_numpy(), p["y"].to_numpy()
            asked, qz = q["repeat"].to_numpy(), np.stack(q["z"])
            qid, limit = q["qid"].to_numpy(), q["limit"].to_numpy()
            sizes = np.array([len(v) for v in p["out"]])
            owner, gone = np.repeat(np.arange(len(p)), sizes), np.concatenate([np.asarray(v, np.int64) for v in p["out"]])
            for r in np.unique(asked):
                live = np.ones(len(p), bool)
                live[owner[gone == r]] = False
                if not live.any():
                    continue
                a, a_tid, a_y = z[live] @ metrics.maps[int(r)].T, tid[live], y[live]
                norm, of = (a**2).sum(1), np.flatnonzero(asked == r)
                step = max(1, TABLE // len(a))
                for lo in range(0, len(of), step):
                    at = of[lo:lo + step]
                    b = qz[at] @ metrics.maps[int(r)].T
                    rough = norm - 2 * (b @ a.T) + (b**2).sum(1)[:, None]
                    slack = 1e-10 * (norm.max() + (b**2).sum(1) + 1.0)
                    kk = min(k, len(a))
                    most = np.minimum(np.partition(rough, kk - 1, axis=1)[:, kk - 1], limit[at] ** 2) + slack
                    i, j = np.nonzero(rough <= most[:, None])
                    d = np.sqrt(((a[j] - b[i]) ** 2).sum(1))
                    order = np.lexsort((a_tid[j], d, i))
                    i, j, d = i[order], j[order], d[order]
                    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                    i, j, d = i[keep], j[keep], d[keep]
                    found.append(pd.DataFrame({"repeat": int(r), "qid": qid[at][i], "dist": d, "tid": a_tid[j], "y": a_y[j]}))
        return pd.concat(found) if found else pd.DataFrame({"repeat": [], "qid": [], "dist": [], "tid": [], "y": []})

    keys = ["cell", "p", "q"]
    return (dealt(points, ["tid"], "p", "q").groupBy(keys)
            .cogroup(dealt(queries, ["repeat", "qid"], "q", "p").groupBy(keys))
            .applyInPandas(nearest, "repeat int, qid long, dist double, tid long, y double"))


def predict_knn(fits: HeldFits, pool: DataFrame, held: DataFrame, repeat: str, k: int = 21,
                report: dict | None = None) -> DataFrame:
    """(repeat, grain, actual, pred) of the held-out rows; see the module docstring. The grain is
    unique in ``pool``; a repeat without train rows predicts null. ``report`` receives the (query,
    point) pairs compared and those of all pairs."""
    ship(pool.sparkSession)
    metrics, z = Metrics(fits), fits.design.vector().alias("z")
    asked = cut_lineage(held.select(F.col(repeat).cast("int").alias("repeat"), grain_key().alias("qid"), z))
    out = asked.groupBy("qid").agg(F.collect_set("repeat").alias("out"))  # at most the repeats
    points = pool.select(grain_key().alias("tid"), F.col(TARGET).cast("double").alias("y"), z)
    points = lookup_join(points, out.withColumnRenamed("qid", "tid"), ["tid"], "left")
    points = cut_lineage(points.withColumn("out", F.coalesce("out", F.array().cast("array<int>"))))
    n = points.count()
    wanted = max(1, math.isqrt(n))
    chosen = points.where(F.col("tid") < int(KEYS / max(n, 1) * wanted)).select("z").collect() or points.select("z").take(1)
    whole = metrics.maps[0]
    if not chosen:
        return held.select(repeat, MONTH, *COHORT, TARGET, F.lit(None).cast("double").alias("pred"))
    pivots = np.unique(np.array([r["z"] for r in chosen]) @ whole.T, axis=0)
    step = max(1, TABLE // len(pivots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                d = _apart(matrix(part.column(2)) @ whole.T, pivots)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))],
                                                 ["tid", "y", "z", "out", "cell", "far"])

    points = points.select("tid", "y", "z", "out")
    points = cut_lineage(points.mapInArrow(place, "tid long, y double, z array<double>, out array<int>, cell int, far double"))
    size, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect():
        size[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    left = {r: size.copy() for r in fits.train}
    gone = points.select("cell", F.explode("out").alias("r")).groupBy("cell", "r").agg(F.count(F.lit(1)).alias("n"))
    for r in gone.collect():  # at most pivots times repeats
        left[r["r"]][r["cell"]] -= r["n"]
    points = points.drop("far")

    def cells(d: np.ndarray, has: np.ndarray) -> np.ndarray:
        """Per query, the nearest cells that together hold k train points."""
        order = np.argsort(d, axis=1, kind="stable")
        before = np.cumsum(has[order], axis=1) - has[order]
        met = np.zeros(d.shape, bool)
        np.put_along_axis(met, order, before < min(k, has.sum()), axis=1)
        return met & (has > 0)

    def to_cells(second: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of = batch.column(0).to_numpy(zero_copy_only=False) if batch.num_rows else np.zeros(0, int)
                for r in np.unique(of):
                    own = batch.filter(pa.array(of == r))
                    for lo in range(0, own.num_rows, step):
                        part = own.slice(lo, step)
                        rows = matrix(part.column(2))
                        x, has = rows @ whole.T, left[int(r)]
                        d = _apart(x, pivots)
                        met = cells(d, has)
                        limit = part.column(3).to_numpy(zero_copy_only=False)
                        if second:
                            o = d.argmin(1)
                            apart = _apart(pivots[o], pivots)
                            border = np.where(apart > 0, (d**2 - d.min(1)[:, None] ** 2) / np.where(apart > 0, 2 * apart, 1.0), 0.0)
                            low = np.maximum(np.maximum(d - radius, border), 0.0)
                            lone = (x[:, metrics.lone[int(r)]] ** 2).sum(1)
                            low = metrics.ratio[int(r)] * _root(low**2 - lone[:, None]) - metrics.moved[int(r)]
                            # a hair of slack, so that rounding never leaves a cell out
                            met = (low <= limit[:, None] * (1 + 1e-9) + 1e-9) & (has > 0) & ~met
                        i, c = np.nonzero(met)
                        for at in range(0, len(i), POINT_ROWS):
                            s = slice(at, at + POINT_ROWS)
                            yield pa.RecordBatch.from_arrays(
                                [part.column(0).take(pa.array(i[s])), part.column(1).take(pa.array(i[s])), _arrays(rows[i[s]]),
                                 pa.array(limit[i[s]]), pa.array(c[s].astype(np.int32))], ["repeat", "qid", "z", "limit", "cell"])
        return run

    shape = "repeat int, qid long, z array<double>, limit double, cell int"
    own = ["repeat", "qid"]
    one = cut_lineage(asked.withColumn("limit", F.lit(float("inf"))).mapInArrow(to_cells(False), shape))
    near = cut_lineage(_met(one, points, metrics, k))
    by_distance = Window.partitionBy(*own).orderBy("dist", "tid")
    bound = (near.withColumn("at", F.row_number().over(by_distance)).where(F.col("at") <= k)
             .groupBy(*own).agg(F.max("dist").alias("limit")))
    two = cut_lineage(asked.join(bound, own).select(*own, "z", "limit").mapInArrow(to_cells(True), shape))
    if report is not None:
        met = one.unionByName(two).groupBy("cell").count().collect()
        report["pairs_compared"] = int(sum(size[r["cell"]] * r["count"] for r in met))
        report["all_pairs"] = n * asked.count()
    best = (near.unionByName(_met(two, points, metrics, k))
            .withColumn("at", F.row_number().over(by_distance)).where(F.col("at") <= k))
    got = best.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("dist", "tid", "y"))).alias("nn"))
    got = got.select(F.col("repeat").alias(repeat), "qid", non_negative(neighbour_mean("nn")).alias("pred"))
    rows = held.select(repeat, MONTH, *COHORT, TARGET, grain_key().alias("qid"))
    return lookup_join(rows, got, [repeat, "qid"], "left").drop("qid")
