"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated by a fixed random rotation and split into ``BLOCKS`` blocks of
dimensions. cosine >= t means a squared distance of at most 2 (1 - t), so in some block the
squared distance is at most that block's share of it, in proportion to its dimensions. Each
block is range-joined under its share: a tree of cutting planes, at medians of a bounded sample
of ``SAMPLE`` vectors, parts the block's space into cells, the more the more vectors a label has
(about ``LEAF`` a cell, down to ``DEPTH`` levels; the sample moves the planes, never the result).
A vector stands in its own cell and looks into the earlier cells that are no farther from it than
its radius, all coordinates of the block together. What a cell finds is verified at
once on the original vectors, in double precision; a pair that several blocks find counts
only in the first of them. So no pair is missed, none counts twice, and no pair leaves the
task: a task returns per vector its number of links and its root within the task.

Equal vectors of a label are one class and go on as one row that counts for all. Cells with
many members are dealt as blocks (part, part).

Rows: vectors that are null, empty or zero or hold null or non-finite components, rows
with a null label and rows with a null id link with nothing (n_links 0, own component, kept;
a null id has a null component). Vectors of different lengths don't link. Rows that repeat
an id with an equal vector count each other as links, as other copies do. Columns other than the named
ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.llm.common import out_batches, ship, small_side, stored
from fillwise.llm.components import components
from fillwise.llm.vectors import matrix, usable

COSINE = 0.98
BLOCKS = 8
#: Vectors whose places set the planes, and the fewest of them in a cell.
SAMPLE = 20_000
NODE = 4
#: Rows of a label that a cell should hold, and most levels of planes.
LEAF = 256
DEPTH = 12
#: Rows of a cell in one part.
PART = 2000
TILE = 256
SLACK = 1e-9
SEED = 11

#: A tree that cuts nothing, for vectors of a length that the sample lacks.
WHOLE = (np.full(2, -1, np.int16), np.zeros(2))

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(SEED + dim).normal(size=(dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def rotated(x: np.ndarray, span: slice = slice(None)) -> np.ndarray:
    """Unit vectors, rotated, or a span of their coordinates; a row's doesn't depend on the rows beside it."""
    unit = x / np.sqrt((x**2).sum(1))[:, None]
    r = rotation(x.shape[1])[:, span]
    out = np.zeros((len(x), r.shape[1]))
    for j in range(x.shape[1]):
        out += unit[:, j : j + 1] * r[j]
    return out


def shares(dim: int, cosine: float) -> tuple[list[slice], np.ndarray]:
    """The blocks of dimensions, and each one's share of the squared distance."""
    edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
    spans = [slice(a, b) for a, b in zip(edges, edges[1:])]
    total = 2 * (1 - cosine) + SLACK
    return spans, np.array([total * (s.stop - s.start) / dim for s in spans])


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tree of cutting planes over sampled rows of a block, as a heap (node i has the children 2i
    and 2i + 1, the root is 1): coordinate (-1: not cut) and place, at the median of the widest coordinate."""
    depth = int(np.clip(np.log2(max(len(x), 1) / NODE), 0, DEPTH))
    axis, place = np.full(2 << depth, -1, np.int16), np.zeros(2 << depth)
    held = {1: x}
    for node in range(1, 1 << depth):
        rows = held.pop(node, x[:0])
        if len(rows) < 2:
            continue
        wide = rows.var(0)
        j = int(np.argmax(wide))
        t = float(np.median(rows[:, j]))
        right = rows[:, j] > t
        if wide[j] > 0 and right.any():
            axis[node], place[node] = j, t
            held[2 * node], held[2 * node + 1] = rows[~right], rows[right]
    return axis, place


def cells(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, is its own cell): the own cell of each row of a block, ``depth`` (of its label) levels down,
    and the earlier cells that the ball of the share around it may reach."""
    axis, place = tree
    limit = share * (1 + 1e-6)
    row, node = np.arange(len(x)), np.ones(len(x), np.int64)
    home, away = np.ones(len(x), bool), np.zeros_like(x)
    done: list[tuple] = []
    level = 0
    while len(row):
        j = axis[node]
        last = (j < 0) | (level >= depth[row])
        done.append((row[last], node[last], home[last]))
        row, node, home, away, j = row[~last], node[~last], home[~last], away[~last], j[~last]
        off = x[row, j] - place[node]
        right = off > 0
        # the near side keeps its distance; the far side lies at least |off| away along this coordinate
        far = away.copy()
        at = np.arange(len(row))
        far[at, j] = np.maximum(far[at, j], np.abs(off))
        # right of the own path cells come later: those rows look over here
        reach = ((far**2).sum(1) <= limit) & ~(home & ~right)
        row, home = np.concatenate([row, row[reach]]), np.concatenate([home, np.zeros(reach.sum(), bool)])
        node = np.concatenate([2 * node + right, 2 * node[reach] + ~right[reach]])
        away = np.concatenate([away, far[reach]])
        level += 1
    return tuple(np.concatenate(c) for c in zip(*done)) if done else (row, node, home)


def linked(x: np.ndarray, block: int, home: np.ndarray, lookers: slice, own: np.ndarray, ids: np.ndarray,
           cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked (home row, looking row) pairs of a cell that no earlier block finds."""
    spans, share = shares(x.shape[1], cosine)
    zb = rotated(x, spans[block])
    square = (zb**2).sum(1)
    norm = np.sqrt((x**2).sum(1))
    base = lookers.start
    for i in range(0, len(home), TILE):
        h = home[i : i + TILE]
        near = square[h][:, None] + square[None, lookers] - 2 * zb[h] @ zb[lookers].T <= share[block] + 1e-7
        # within the own cell the larger id looks at the smaller one
        near &= ~own[None, lookers] | (ids[None, lookers] > ids[h][:, None])
        a, b = np.nonzero(near)
        for k in range(0, len(a), 20_000):
            u, v = h[a[k : k + 20_000]], b[k : k + 20_000] + base
            # only what the block finds is rotated whole
            rows, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            z = rotated(x[rows])
            d = (z[at[: len(u)]] - z[at[len(u) :]]) ** 2
            first = np.full(len(u), -1)
            for c in range(block, -1, -1):
                first[d[:, spans[c]].sum(1) <= share[c]] = c
            ok = (first == block) & ((x[u] * x[v]).sum(1) >= cosine * norm[u] * norm[v])
            yield u[ok], v[ok]


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    ship(rows.sparkSession)
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, raw = usable(batch.column(2))
            linkable = batch.column(0).is_valid().to_numpy(zero_copy_only=False) & batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            v: list[bytes | None] = [None] * batch.num_rows
            for i, b in zip(ok.tolist(), raw):
                if linkable[i]:
                    v[i] = b
            d = [None if b is None else xxhash.xxh3_128_digest(b) for b in v]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d, pa.binary()), pa.array(v, pa.binary())],
                                             ["vec_id", "label", "digest", "v"])

    plain = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                        F.col(vector).cast("array<float>").alias("v"))
    every = stored(plain.mapInArrow(read, "vec_id long, label string, digest binary, v binary"))
    # written, so that the joins below shuffle plainly and a class of very many rows can be split
    classes = stored(every.where(F.col("digest").isNotNull()).groupBy("label", "digest").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    heads = (every.join(classes, ["label", "digest"]).where(F.col("vec_id") == F.col("node"))
             .select("node", "label", "copies", "v", "digest").dropDuplicates(["node", "label", "digest"]))
    trees = _trees(heads)
    # rows of a label are counted once a label, after the copies are one row
    deep = F.greatest(F.ceil(F.log2(F.col("rows") / LEAF)), F.lit(0)).cast("int").alias("deep")
    depths = small_side(stored(heads.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).select("label", deep)))
    schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("v", pa.binary()), ("grp", pa.int64()), ("blk", pa.int32()), ("own", pa.bool_())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                node, labels, copies, v, depth = (c.to_pylist() for c in batch.columns)
                by_dim: dict[int, list[int]] = {}
                for i, b in enumerate(v):
                    by_dim.setdefault(len(b) // 4, []).append(i)
                for dim, at in by_dim.items():
                    z = rotated(matrix([v[i] for i in at], dim))
                    spans, share = shares(dim, cosine)
                    deep = np.array([depth[i] for i in at])
                    for c, s in enumerate(spans):
                        tree = trees[dim][c] if dim in trees else WHOLE
                        for r, cell, own in zip(*(x.tolist() for x in cells(z[:, s], tree, deep, share[c]))):
                            i = at[r]
                            # groups are told apart by a hash; strangers in one group fail the exact check
                            g = xxhash.xxh3_64_intdigest(f"{labels[i]}|{dim}|{c}|{cell}") - (1 << 63)
                            yield node[i], copies[i], v[i], g, c, own

        yield from out_batches(out(), schema)

    placed = stored(heads.join(depths, "label").select("node", "label", "copies", "v", "deep").mapInArrow(
        place, "node long, copies long, v binary, grp long, blk int, own boolean"))
    size = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("own").cast("int")).alias("homes"))
    size = size.where((F.col("members") > 1) & (F.col("homes") > 0)).select("grp", F.ceil(F.col("members") / PART).cast("int").alias("parts"))
    open_ = placed.join(size, "grp").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # home rows fill the parts p, looking rows the parts q; rows of an own cell do both, and go
    # once where the cell is one part
    every_part = F.sequence(F.lit(0), F.col("parts") - 1)
    none = F.array().cast("array<struct<home:boolean,p:int,q:int>>")

    def role(home: bool):
        return lambda i: F.struct(F.lit(home).alias("home"), *([F.col("part").alias("p"), i.alias("q")] if home else [i.alias("p"), F.col("part").alias("q")]))
    roles = F.concat(F.when(F.col("own"), F.transform(every_part, role(True))).otherwise(none),
                     F.when(~F.col("own") | (F.col("parts") > 1), F.transform(every_part, role(False))).otherwise(none))
    dealt = open_.withColumn("role", F.explode(roles)).select("node", "copies", "v", "grp", "blk", "own", "role.home", "parts", "role.p", "role.q")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        out = []
        dims = group["v"].map(len).to_numpy() // 4
        for dim in np.unique(dims):
            g = group[dims == dim]
            home = g["home"].to_numpy()
            whole = int(g["parts"].iloc[0]) == 1
            if not home.any() or (home.all() and not whole):
                continue
            node, copies, own = g["node"].to_numpy(), g["copies"].to_numpy(), g["own"].to_numpy() | home
            x = matrix(g["v"].tolist(), int(dim))
            at_home = np.flatnonzero(home)
            look = np.flatnonzero(~home)
            # positions: homes first, then the looking rows
            order = np.concatenate([at_home, look])
            x, node, copies, own = x[order], node[order], copies[order], own[order]
            links = np.zeros(len(order), np.int64)
            pairs = []
            hx = np.arange(len(at_home))
            lookers = slice(0 if whole else len(at_home), None)
            for u, v in linked(x, int(g["blk"].iloc[0]), hx, lookers, own, node, cosine):
                np.add.at(links, u, copies[v])
                np.add.at(links, v, copies[u])
                pairs.append(np.stack([node[u], node[v]], 1))
            some = links > 0
            if some.any():
                root = _roots(np.concatenate(pairs))
                out.append(pd.DataFrame({"node": node[some], "links": links[some], "root": [root[n] for n in node[some].tolist()]}))
        return pd.concat(out) if out else empty

    found = stored(dealt.groupBy("grp", "p", "q").applyInPandas(join, "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    final = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    known = (classes.join(links, "node", "left").join(final, "node", "left")
             .select("label", "digest", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "node").alias("component")))
    component = F.coalesce("component", "vec_id")
    return every.drop("v").join(known, ["label", "digest"], "left").select(
        "vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _trees(heads: DataFrame) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Per vector length, each block's planes, from a sample of ``SAMPLE`` rows by hash."""
    some = heads.select("v", F.xxhash64("digest", F.lit(SEED)).alias("h")).orderBy("h").limit(SAMPLE).collect()
    of: dict[int, list[bytes]] = {}
    for r in some:
        of.setdefault(len(r["v"]) // 4, []).append(bytes(r["v"]))
    out = {}
    for dim, v in of.items():
        z = rotated(matrix(v, dim))
        out[dim] = [planes(z[:, span]) for span in shares(dim, COSINE)[0]]
    return out


def _roots(pairs: np.ndarray) -> dict[int, int]:
    """The smallest node that each node of the pairs reaches through them."""
    nodes, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(-1, 2)
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[at[:, 0]], root[at[:, 1]])
        new = root.copy()
        np.minimum.at(new, at[:, 0], least)
        np.minimum.at(new, at[:, 1], least)
        new = new[new]
        if (new == root).all():
            return dict(zip(nodes.tolist(), nodes[root].tolist()))
        root = new
