"""Approximate nearest neighbours over learned partitions.

A bounded, hashed sample of the vectors gets a neighbour graph (computed by Spark tasks). The
graph is split into equal parts by recursive bisection: the slow eigenvector of the graph's
random walk orders the nodes, the median cuts them, and balanced swaps lower the cut. A small
neural classifier learns from each sample vector the parts in which its neighbours lie. Every
vector is indexed in its most probable part; a query goes to its most probable parts, as
many as a calibration on sample queries needs for the target recall, and all vectors there
are ranked by exact distance.

Parts and the queries routed to them are dealt in chunks, so neither a large part nor a
popular one meets in one task; each pair of chunks returns at most k rows a query.

Rows: vectors that are null, empty or zero or hold null or non-finite components take no
part, nor do null ids; a vector's length must be the table's most frequent one. Equal
distances go to the smaller id. Repeated rows count once; an id with several vectors is as near
as the nearest of them, also where it asks, and is never its own answer. Without usable vectors the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillwise.llm.common import out_batches, partitions, ship, stored
from fillwise.llm.vectors import matrix, usable

K = 10
#: Vectors of the sample at most, neighbours of each in the graph, and parts.
SAMPLE = 12_000
GRAPH_K = 10
PARTS = 16
#: Recall on sample queries that sets the number of probes.
TARGET = 0.94
CALIBRATION = 1_000
HIDDEN = 64
EPOCHS = 12
BASE_ROWS = 4096
QUERY_ROWS = 2048
SEED = 5


def nearest(q: np.ndarray, base: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Rows of base nearest to each q (row skip[i] of base is left out for q i)."""
    d = (base**2).sum(1)[None, :] - 2 * q @ base.T
    if skip is not None:
        d[np.arange(len(q)), skip] = np.inf
    k = min(k, d.shape[1] - 1) if d.shape[1] > 1 else 1
    return np.argpartition(d, k - 1, axis=1)[:, :k]


# -- balanced partitioning of the neighbour graph ------------------------------------------------


def bisect(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two equal halves (0/1) of a graph's n nodes with few edges between them."""
    a, b = np.concatenate([edges, edges[:, ::-1]]).T
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    x = rng.normal(size=n)
    for _ in range(40):  # lazy walk; its constant direction is taken out
        x = 0.5 * x + 0.5 * np.bincount(a, x[b], n) / degree
        x -= (x * degree).sum() / degree.sum()
        x /= np.sqrt((x**2).sum()) + 1e-30
    side = np.zeros(n, np.int64)
    side[np.argsort(x, kind="stable")[n // 2 :]] = 1
    for _ in range(10):  # swap as many of either side as gain by moving
        other = np.bincount(a, (side[a] != side[b]).astype(float), n)
        gain = 2 * other - np.bincount(a, minlength=n)
        left = np.flatnonzero((side == 0) & (gain > 0))
        right = np.flatnonzero((side == 1) & (gain > 0))
        m = min(len(left), len(right)) // 2
        if not m:
            break
        side[left[np.argsort(-gain[left], kind="stable")[:m]]] = 1
        side[right[np.argsort(-gain[right], kind="stable")[:m]]] = 0
    return side


def balanced_parts(neighbours: np.ndarray, parts: int) -> np.ndarray:
    """The part of each node; parts is a power of two."""
    n = len(neighbours)
    rng = np.random.default_rng(SEED)
    edges = np.stack([np.repeat(np.arange(n), neighbours.shape[1]), neighbours.ravel()], 1)
    part = np.zeros(n, np.int64)
    p = 1
    while p < parts:
        new = np.empty(n, np.int64)
        for c in range(p):
            at = np.flatnonzero(part == c)
            place = np.full(n, -1)
            place[at] = np.arange(len(at))
            inner = place[edges]
            inner = inner[(inner >= 0).all(1)]
            new[at] = 2 * c + (bisect(inner, len(at), rng) if len(at) > 1 else 0)
        part, p = new, 2 * p
    return part


# -- the router ----------------------------------------------------------------------------------


@dataclass
class Index:
    dim: int
    weights: list[np.ndarray]
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        unit = x / np.sqrt((x**2).sum(1))[:, None]
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2


def train_router(x: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
    """One hidden layer, cross-entropy against the parts of the neighbours, by Adam."""
    rng = np.random.default_rng(SEED)
    x = x / np.sqrt((x**2).sum(1))[:, None]
    d, k = x.shape[1], goal.shape[1]
    w = [rng.normal(0, np.sqrt(2), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, k)), np.zeros(k)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            xb, yb = x[order[i : i + 256]], goal[order[i : i + 256]]
            h = np.maximum(xb @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - yb) / len(xb)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for j, s in enumerate((xb.T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[j] = 0.9 * m[j] + 0.1 * s
                v[j] = 0.999 * v[j] + 0.001 * s * s
                w[j] = w[j] - 0.003 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return w


def read(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, dim, v) of the usable vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = usable(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([len(b) // 4 for b in raw], pa.int32()),
                                              pa.array(raw, pa.binary())], ["vec_id", "dim", "v"])

    plain = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"),
                                                      F.col(vector).cast("array<float>").alias("v"))
    return plain.mapInArrow(run, "vec_id long, dim int, v binary")


def fit(rows: DataFrame, parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET) -> Index | None:
    """Learn the partitions from a sample of ``read`` rows."""
    sizes = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        return None
    dim, n = sizes[0]["dim"], sizes[0]["count"]
    chosen = rows.where(F.col("dim") == dim)
    # distinct vectors teach; an expected ``sample`` of them, by a hash of id and vector
    chosen = chosen.where(F.pmod(F.xxhash64("vec_id", "v", F.lit(9)), F.lit(1 << 24)) < int((1 << 24) * min(1.0, sample / n)))
    raw = sorted({r["v"] for r in chosen.select("v").collect()})
    x = matrix(raw, dim)
    while parts > 2 and len(x) < 16 * parts:
        parts //= 2
    if len(x) < 32:
        return Index(dim, [np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)

    def graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i in range(0, len(ids), 512):
                at = ids[i : i + 512]
                near = nearest(x[at], x, GRAPH_K, skip=at)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(near))], ["node", "near"])

    spark = rows.sparkSession
    found = spark.range(len(x)).repartition(min(partitions(spark), 12)).mapInArrow(graph, "node long, near array<long>").collect()
    neighbours = np.empty((len(x), min(GRAPH_K, len(x) - 1)), np.int64)
    for r in found:
        neighbours[r["node"]] = r["near"]
    part = balanced_parts(neighbours, parts)
    held = np.random.default_rng(SEED).permutation(len(x))[: min(CALIBRATION, len(x) // 4)]
    learn = np.setdiff1d(np.arange(len(x)), held)
    goal = np.zeros((len(x), parts))
    for j in range(neighbours.shape[1]):
        np.add.at(goal, (np.arange(len(x)), part[neighbours[:, j]]), 1)
    goal[np.arange(len(x)), part] += 1
    goal /= goal.sum(1, keepdims=True)
    index = Index(dim, train_router(x[learn], goal[learn]), parts)
    scores = index.scores(x)
    place = scores.argmax(1)
    rank = np.argsort(np.argsort(-scores[held], axis=1, kind="stable"), axis=1)
    need = np.take_along_axis(rank, place[neighbours[held]], 1)
    recall = [(need < p).mean() for p in range(1, parts + 1)]
    index.probes = next(p for p in range(1, parts + 1) if recall[p - 1] >= target or p == parts)
    return index


def routed(rows: DataFrame, index: Index, probes: int) -> DataFrame:
    """(vec_id, v, part) for the ``probes`` most probable parts of each vector."""
    ship(rows.sparkSession)
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("part", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                ids, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                if ids:
                    top = np.argsort(-index.scores(matrix(raw, index.dim)), axis=1, kind="stable")[:, :probes]
                    for i, v, ps in zip(ids, raw, top.tolist()):
                        for p in ps:
                            yield i, v, p

        yield from out_batches(out(), schema)

    return rows.where(F.col("dim") == index.dim).select("vec_id", "v").mapInArrow(run, "vec_id long, v binary, part int")


def search(rows: DataFrame, queries: Column, k: int = K, key: str = "vec_id", vector: str = "embedding",
           index: Index | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for the rows that ``queries``
    (a condition on vec_id) picks."""
    ship(rows.sparkSession)
    # a repeated row counts once, as a query and as a candidate
    vectors = stored(read(rows, key, vector).dropDuplicates(["vec_id", "v"]))
    index = index or fit(vectors)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = stored(routed(vectors, index, 1))
    asked = stored(routed(vectors.where(queries), index, index.probes))
    # a row for each part: chunks of the vectors there and of the queries that go there
    chunks = (base.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BASE_ROWS).cast("int").alias("bases"))
              .join(asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("askers")), "part"))
    chunks = F.broadcast(stored(chunks))  # at most PARTS rows

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        return (df.join(chunks, "part").withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.col(own + "s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)))
                .select("part", "base", "asker", "vec_id", "v"))

    dim = index.dim

    def rank(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(b) and len(q):
            b = b.sort_values("vec_id", kind="stable")
            ids, x = b["vec_id"].to_numpy(), matrix(b["v"].tolist(), dim)
            heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            bounds = np.append(heads, len(ids))
            square = (x**2).sum(1)
            qx = matrix(q["v"].tolist(), dim)
            for i in range(0, len(q), 128):
                near = square[None, :] - 2 * qx[i : i + 128] @ x.T
                own = q["vec_id"].to_numpy()[i : i + 128]
                near[own[:, None] == ids[None, :]] = np.inf
                if len(heads) < len(ids):  # an id with several vectors is as near as its nearest
                    near = np.minimum.reduceat(near, heads, axis=1)
                kth = np.partition(near, min(k, len(heads)) - 1, axis=1)[:, min(k, len(heads)) - 1]
                for j in range(len(near)):
                    slack = 1e-9 * (1 + (qx[i + j] ** 2).sum() + abs(kth[j])) if np.isfinite(kth[j]) else 0.0
                    at = np.flatnonzero((near[j] <= kth[j] + slack) & np.isfinite(near[j]))
                    score = np.array([np.sqrt(((x[bounds[a] : bounds[a + 1]] - qx[i + j]) ** 2).sum(1)).min() for a in at])
                    best = np.lexsort((ids[heads[at]], score))[:k]
                    out.append((np.full(len(best), own[j]), ids[heads[at]][best], score[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    keys = ["part", "base", "asker"]
    found = (dealt(base, "base", "asker").groupBy(keys).cogroup(dealt(asked, "asker", "base").groupBy(keys))
             .applyInPandas(rank, "query_id long, vec_id long, score double"))
    # an id with several vectors asks with each of them and takes the nearest found by any
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
