"""Exact k-nearest-neighbour regression (M7) with pivot cells and distance bounds.

Features are the tree feature set, standardized with the train mean and
population standard deviation (a zero deviation scales by 1). Prediction:
distance-weighted mean (1/d) of the k nearest train targets; when some of them
are at distance 0, the mean of those only. Clipped at 0. Ties at the k-th distance
go to the smaller md5 key of the train row's grain.

Exact without a candidate cap and without comparing all pairs:

1. Pivots are train points (smallest keys), as many as the square root of the train
   size. Each train point belongs to its nearest pivot's cell; a cell keeps its row
   count and radius. Pivots and cell stats are model data of the tasks (square root
   of the rows), not columns.
2. Phase 1: a query meets its nearest cells that together hold at least k points; the
   k-th smallest distance there, theta, bounds its true k-th distance from above.
3. Phase 2: a point of cell c is at least max(D_c - R_c, (D_c^2 - D_o^2) / (2 d(p_o, p_c)))
   away from the query (triangle inequality; Voronoi bound with its nearest pivot o).
   Only cells whose bound is at most theta are met.

A cell's points and the queries sent there meet in blocks of bounded size (a hot cell,
say of equal points, is many blocks), and each block returns at most k rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, MONTH, TARGET
from fillwise.functions.joins import lookup_join
from fillwise.functions.safe import non_negative
from fillwise.operators import ml
from fillwise.session import cut_lineage, ship

#: Train points and queries in one block.
POINT_ROWS = 4096
QUERY_ROWS = 2048


def grain_key() -> Column:
    """First 60 bits of the md5 of a row's grain."""
    text = F.concat_ws("|", F.col(MONTH).cast("string"), *[F.col(c) for c in COHORT])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def neighbour_mean(nn: str) -> Column:
    """Mean of the targets of (dist, tid, y) neighbours weighted by 1 / distance; of those at distance 0 only, if any."""
    zero = F.filter(nn, lambda e: e["dist"] == 0)
    mean_zero = F.aggregate(zero, F.lit(0.0), lambda a, e: a + e["y"]) / F.size(zero)
    weighted = F.aggregate(nn, F.lit(0.0), lambda a, e: a + e["y"] / e["dist"])
    weights = F.aggregate(nn, F.lit(0.0), lambda a, e: a + F.lit(1.0) / e["dist"])
    return F.when(F.size(zero) > 0, mean_zero).otherwise(weighted / weights)


def _points(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    for i in range(len(a)):
        out[i] = np.sqrt(((b - a[i]) ** 2).sum(1))
    return out


def _met(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(qid, dist, tid, y): per block the k nearest of the points that share a query's cell."""
    def blocks(df: DataFrame, own: str, rows: int) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(own))

    plan = cut_lineage(blocks(points, "ps", POINT_ROWS).join(blocks(queries, "qs", QUERY_ROWS), "cell"))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return (df.join(plan, "cell").withColumn(own, F.pmod(F.xxhash64(key), F.col(own + "s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1))).drop("ps", "qs"))

    def nearest(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(p) and len(q):
            x, tid, y = np.stack(p["x"]), p["tid"].to_numpy(), p["y"].to_numpy()
            for qid, v in zip(q["qid"], q["x"]):
                d = np.sqrt(((x - v) ** 2).sum(1))
                best = np.lexsort((tid, d))[:k]
                out.append(pd.DataFrame({"qid": qid, "dist": d[best], "tid": tid[best], "y": y[best]}))
        return pd.concat(out) if out else pd.DataFrame({"qid": [], "dist": [], "tid": [], "y": []})

    keys = ["cell", "p", "q"]
    return (dealt(points, "tid", "p", "q").groupBy(keys).cogroup(dealt(queries, "qid", "q", "p").groupBy(keys))
            .applyInPandas(nearest, "qid long, dist double, tid long, y double"))


def fit_predict_knn(train: DataFrame, score: DataFrame, k: int = 21, out: str = "pred",
                    report: dict | None = None) -> DataFrame:
    """M7 on the tree feature set; exact, see the module docstring. ``report``
    receives the number of pairs compared and of all pairs, when given."""
    spark = train.sparkSession
    ship(spark)
    tr, sc = ml._features(train, score)
    enc = ml._tree_encoder(ml.TREE_NUMERIC).fit(tr)

    def raw(df: DataFrame, key: str) -> DataFrame:
        return enc.transform(df).select(grain_key().alias(key), F.col(TARGET).cast("double").alias("y"),
                                        vector_to_array("features").alias("x"))

    points = cut_lineage(raw(tr, "tid"))
    # one row per feature
    stats = (points.select(F.posexplode("x").alias("i", "v")).groupBy("i")
             .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect())
    mean = np.array([r["m"] for r in stats])
    scale = np.array([r["s"] if r["s"] and r["s"] > 0 else 1.0 for r in stats])
    n = points.count()
    if n == 0:
        return score.withColumn(out, F.lit(None).cast("double"))
    chosen = points.orderBy("tid").limit(max(1, math.isqrt(n))).select("x").collect()
    pivots = np.unique((np.array([r["x"] for r in chosen]) - mean) / scale, axis=0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = (_points(batch.column(2)) - mean) / scale
                d = _distances(x, pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(list(x)), pa.array(cell.astype(np.int32)), pa.array(d.min(1))],
                    ["tid", "y", "x", "cell", "far"])

    points = cut_lineage(points.mapInArrow(place, "tid long, y double, x array<double>, cell int, far double"))
    size, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect():
        size[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    points = points.drop("far")

    def first_cells(d: np.ndarray) -> np.ndarray:
        order = np.argsort(d, kind="stable")
        return order[: int(np.searchsorted(np.cumsum(size[order]), min(k, n))) + 1]

    def to_cells(theta: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for i, x in enumerate(_points(batch.column(1)) if batch.num_rows else []):
                    x = x if theta else (x - mean) / scale
                    d = np.sqrt(((pivots - x) ** 2).sum(1))
                    cells = first_cells(d)
                    if theta:
                        o = int(d.argmin())
                        # of the one pivot only: all pairs of pivots would be as many as the train rows
                        apart = np.sqrt(((pivots - pivots[o]) ** 2).sum(1))
                        split = np.where(apart > 0, (d**2 - d[o] ** 2) / np.where(apart > 0, 2 * apart, 1), 0.0)
                        bound = np.maximum(d - radius, split)
                        limit = batch.column(2)[i].as_py()
                        # a hair of slack, so that rounding never leaves a cell out
                        near = (bound <= limit * (1 + 1e-9) + 1e-12) & (size > 0)
                        near[cells] = False
                        cells = np.flatnonzero(near)
                    rows += [(batch.column(0)[i].as_py(), x, int(c)) for c in cells if size[c]]
                if rows:
                    q, x, c = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(list(x)), pa.array(c, pa.int32())], ["qid", "x", "cell"])
        return run

    shape = "qid long, x array<double>, cell int"
    queries = cut_lineage(raw(sc, "qid").select("qid", "x"))
    one = cut_lineage(queries.mapInArrow(to_cells(False), shape))
    near = cut_lineage(_met(one, points, k))
    by_distance = Window.partitionBy("qid").orderBy("dist", "tid")
    theta = (near.withColumn("at", F.row_number().over(by_distance)).where(F.col("at") <= k)
             .groupBy("qid").agg(F.max("dist").alias("theta")))
    centred = one.dropDuplicates(["qid"]).select("qid", "x").join(theta, "qid")
    two = cut_lineage(centred.mapInArrow(to_cells(True), shape))
    if report is not None:
        met = one.unionByName(two).groupBy("cell").count().collect()
        report["pairs_compared"] = int(sum(size[r["cell"]] * r["count"] for r in met))
        report["all_pairs"] = n * queries.count()
    best = (near.unionByName(_met(two, points, k))
            .withColumn("at", F.row_number().over(by_distance)).where(F.col("at") <= k))
    # k rows a query, in order
    got = best.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("dist", "tid", "y"))).alias("nn"))
    got = got.select("qid", non_negative(neighbour_mean("nn")).alias(out))
    return lookup_join(score.withColumn("qid", grain_key()), got, ["qid"], "left").drop("qid")
