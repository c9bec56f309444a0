"""Boosted trees of many fits grown together (M5, M6, B1): histogram trees by level or by leaf.

A *fit* is one training set, such as a backtest repeat: all rows but those that it leaves out.
All fits share one table of rows and one grid of bins. A round grows one tree a fit; a step of
it is one job for every fit and open node: tasks sum counts and residuals per (fit, node, bin),
the sums meet by (fit, node), and only the best split of each comes to the driver. The rows
are packed once in blocks that carry each fit's running prediction, so a left-out row's
prediction is there when the last tree is done. Blocks are rewritten to the shared folder every
``KEEP`` rounds; between, tasks apply the few trees since. So a lost executor costs a re-read.
The blocks are an RDD: a fit is thousands of jobs too short for a query plan each.

* ``LEAVES``: best-first growth to 24 leaves of at least 30 rows. All leaves that could still be
  among the first 23 splits are split for a trial in one job; the order is settled afterwards,
  by gain, so the tree is the one that splitting leaf by leaf gives (ties: the older node).
* ``LEVELS``: four levels, at least 6 rows a leaf, L1 and L2 terms, 0.8 of the rows a round.

Both fit log1p(revenue) from its mean, 350 rounds, rate 0.04, 0.8 of the columns a tree; back by
expm1, clipped at 0. Columns are the cohort levels (level or not) and the numbers, in at
most ``BINS`` bins with edges at approximate quantiles (1e-4 of the ranks) of the rows that some fit
trains on. Residuals are whole multiples of 2**-20, whose sums are exact, so for given edges a fit
doesn't depend on partitions, on their order or on the fits beside it.

Defined cases: a lag gap takes the fit's train median (or the first bin, if it has none); other null numbers take
the first bin; an unseen or null level belongs to no level's column; rows without revenue, or with revenue of
-1 or less, train nothing; a fit without train rows predicts null.
"""

from __future__ import annotations

import heapq
import os
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillwise.config import COHORT, MONTH, STREAMS, TARGET
from fillwise.functions.joins import lookup_join
from fillwise.operators.held_models import NUMBERS, _numbers
from fillwise.operators.ml import LAGS, _levels, lag_medians
from fillwise.session import _run_folder, discard, ship

ONE = float(1 << 20)
BINS = 255
KEEP = 10
#: Rows times fits of one block, and about those of a task: tasks grow in number with the rows.
BLOCK = 120_000
COLUMNS = (*COHORT, *NUMBERS, *LAGS)
FIRST_LAG = len(COLUMNS) - len(LAGS)


@dataclass(frozen=True)
class Rule:
    """How trees grow: by leaf up to ``leaves``, or by level down to ``depth``."""

    leaves: int | None = None
    depth: int | None = None
    least: int = 30
    l1: float = 0.0
    l2: float = 0.0
    rows: float = 1.0
    columns: float = 0.8
    rate: float = 0.04
    rounds: int = 350
    seed: int = 42


LEAVES = Rule(leaves=24, least=30)
LEVELS = Rule(depth=4, least=6, l1=1.0, l2=3.0, rows=0.8)
#: Labels of the two in result tables.
MODELS = {"HistTrees(leaves=24)": LEAVES, "HistTrees(depth=4)": LEVELS}


@dataclass(frozen=True)
class Grid:
    """Where a column's bins lie: levels first (and one bin for no known level), then numbers."""

    levels: tuple[tuple[str, ...], ...]
    edges: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, rows: DataFrame) -> Grid:
        levels = _levels(rows)
        wanted = [float(q) for q in np.linspace(0, 1, BINS)]
        found = rows.agg(*[F.percentile_approx(c, F.lit(wanted), 10_000).alias(n) for n, c in _numbers().items()]).first()
        return cls(tuple(tuple(levels[c]) for c in COHORT),
                   tuple(np.unique(np.array(found[n] or [], float)) for n in (*NUMBERS, *LAGS)))

    @property
    def widths(self) -> list[int]:
        return [len(v) + 1 for v in self.levels] + [len(e) + 1 for e in self.edges]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)])

    def code(self, column: int, values: np.ndarray) -> np.ndarray:
        """Bins of numbers: bin b holds values up to edge b; null (NaN) is the first bin."""
        edges = self.edges[column - len(COHORT)]
        return np.where(np.isnan(values), 0, np.searchsorted(edges, values, "left")).astype(np.int16)

    def choice(self, rule: Rule, turn: int) -> np.ndarray:
        """The splits of one round's columns: a level, or a bin that is not its number's last."""
        w, s = self.widths, self.starts
        real = [np.arange(s[c], s[c] + w[c] - 1) for c in range(len(w))]
        units = [[i] for c in range(len(COHORT)) for i in real[c]] + [list(r) for r in real[len(COHORT):]]
        order = np.random.default_rng([rule.seed, turn]).permutation(len(units))
        out = np.zeros(s[-1], bool)
        for u in order[:max(1, round(rule.columns * len(units)))]:
            out[units[u]] = True
        return out


@dataclass
class Block:
    """Rows of one task: bins, gaps, label, train marks and running predictions per fit."""

    kept: list
    key: np.ndarray
    bins: np.ndarray
    gap: np.ndarray
    label: np.ndarray
    train: np.ndarray
    asked: np.ndarray
    now: np.ndarray

    def codes(self, fill: np.ndarray) -> np.ndarray:
        """(fit, row, column) bins, gaps filled with each fit's median."""
        out = np.repeat(self.bins[None], len(fill), 0)
        out[:, :, FIRST_LAG:] = np.where(self.gap[None], fill[:, None, :], out[:, :, FIRST_LAG:])
        return out


@dataclass
class Trees:
    """One tree a fit, as tables (fit, node): column (-1: leaf), bin, first child (the second follows), value."""

    column: np.ndarray
    bin: np.ndarray
    child: np.ndarray
    value: np.ndarray

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every (fit, row)."""
        fits, rows, wide = codes.shape
        flat = codes.ravel()
        here = np.arange(fits * rows) * wide
        base = np.repeat(np.arange(fits) * self.column.shape[1], rows)
        column, bins, child = self.column.ravel(), self.bin.ravel(), self.child.ravel()
        at = np.zeros(fits * rows, np.int32)
        live = np.flatnonzero(column[base] >= 0)
        while len(live):
            node = base[live] + at[live]
            c = column[node]
            v, b = flat[here[live] + c], bins[node]
            right = np.where(c < len(COHORT), v == b, v > b)
            at[live] = child[node] + right
            live = live[column[base[live] + at[live]] >= 0]
        return at.reshape(fits, rows)


@dataclass
class Node:
    total: float
    rows: int
    depth: int
    split: tuple | None = None  # gain, column, bin, left total, left rows
    child: int = -1


@dataclass
class Growing:
    """One fit's tree while it grows; the driver holds some dozens of nodes."""

    rule: Rule
    nodes: list[Node] = field(default_factory=lambda: [Node(0.0, 0, 0)])
    open: list[int] = field(default_factory=lambda: [0])

    def found(self, at: int, total: float, rows: int, split: tuple | None) -> None:
        n = self.nodes[at]
        n.total, n.rows, n.split = total, rows, split

    def step(self) -> None:
        """Splits what must be split next; ``open`` are the new nodes whose best split is not known."""
        self.open = []
        while not self.open:
            chosen = [i for i in self.splits() if self.nodes[i].child < 0]
            if not chosen:
                return
            for i in chosen:
                p = self.nodes[i]
                _, _, _, total, rows = p.split
                p.child = len(self.nodes)
                for t, n in ((total, rows), (p.total - total, p.rows - rows)):
                    self.nodes.append(Node(t, n, p.depth + 1))
                    if n >= 2 * self.rule.least and (self.rule.depth is None or p.depth + 1 < self.rule.depth):
                        self.open.append(len(self.nodes) - 1)

    def splits(self) -> list[int]:
        """The nodes that split, best first, as far as gains are known."""
        if self.rule.leaves is None:
            return [i for i, n in enumerate(self.nodes) if n.split]
        out, heap = [], [(-self.nodes[0].split[0], 0)] if self.nodes[0].split else []
        while heap and len(out) < self.rule.leaves - 1:
            _, i = heapq.heappop(heap)
            out.append(i)
            c = self.nodes[i].child
            for j in (c, c + 1) if c >= 0 else ():
                if self.nodes[j].split:
                    heapq.heappush(heap, (-self.nodes[j].split[0], j))
        return out


def _soft(total, l1: float):
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0.0)


def trees_of(growing: Sequence[Growing], final: bool) -> Trees:
    """Tables of the trees; before the end every trial split counts and no node has a value."""
    most = max(len(g.nodes) for g in growing)
    column, value = np.full((len(growing), most), -1, np.int16), np.zeros((len(growing), most))
    bins, child = np.zeros((len(growing), most), np.int16), np.zeros((len(growing), most), np.int32)
    for f, g in enumerate(growing):
        inner = set(g.splits()) if final else {i for i, n in enumerate(g.nodes) if n.child >= 0}
        for i, n in enumerate(g.nodes):
            if i in inner and n.child >= 0:
                column[f, i], bins[f, i], child[f, i] = n.split[1], n.split[2], n.child
            elif n.rows:
                value[f, i] = g.rule.rate * float(_soft(n.total / ONE, g.rule.l1)) / (n.rows + g.rule.l2)
    return Trees(column, bins, child, np.round(value * ONE))


def best_split(sums: np.ndarray, grid: Grid, allowed: np.ndarray, rule: Rule) -> tuple:
    """(total, rows, split) of one node from its (residual, count) per bin; ties: the first bin."""
    starts = grid.starts
    g, n = sums[0], sums[1]
    total, rows = float(g[: starts[1]].sum()), int(n[: starts[1]].sum())
    # a level's bin is the right side of its split; a number's bins up to b the left side
    left, count = np.empty_like(g), np.empty_like(n)
    for c in range(len(COLUMNS)):
        s = slice(starts[c], starts[c + 1])
        left[s], count[s] = (total - g[s], rows - n[s]) if c < len(COHORT) else (np.cumsum(g[s]), np.cumsum(n[s]))
    ok = allowed & (count >= rule.least) & (rows - count >= rule.least)
    if not ok.any():
        return total, rows, None

    def score(t, k):
        return _soft(t / ONE, rule.l1) ** 2 / (k + rule.l2)
    at = np.flatnonzero(ok)
    gain = score(left[at], count[at]) + score(total - left[at], rows - count[at]) - score(total, rows)
    best = int(np.argmax(gain))
    if not gain[best] > 1e-9:
        return total, rows, None
    cell = int(at[best])
    c = int(np.searchsorted(starts, cell, "right")) - 1
    return total, rows, (float(gain[best]), c, cell - int(starts[c]), float(left[cell]), int(count[cell]))


def _drawn(key: np.ndarray, rule: Rule, turn: int) -> np.ndarray:
    """Rows of a round, by a mix of the row's hash and the round."""
    if rule.rows >= 1:
        return np.ones(len(key), bool)
    x = key + np.uint64(((turn + 1) * 0x9E3779B97F4A7C15 + rule.seed) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < rule.rows


def _advance(block: Block, codes: np.ndarray, since: Sequence[Trees]) -> np.ndarray:
    now = block.now
    at = np.arange(len(codes))[:, None]
    for t in since:
        now = now + t.value[at, t.nodes(codes)]
    return now


def grown(blocks: RDD, grid: Grid, fill: np.ndarray, start: np.ndarray, rule: Rule, folder: str, spark) -> tuple[RDD, list[Trees]]:
    """Blocks after all rounds, and the trees of the last rounds that they don't yet hold."""
    fits, width = len(fill), int(grid.starts[-1])
    starts, parts = grid.starts[:-1], blocks.getNumPartitions()
    since: list[Trees] = []
    written: str | None = None
    for turn in range(rule.rounds):
        allowed = grid.choice(rule, turn)
        growing = [Growing(rule) for _ in range(fits)]
        for g, s in zip(growing, start):
            if np.isnan(s):
                g.open = []
        while any(g.open for g in growing):
            trial = trees_of(growing, False)
            slots = [(f, n) for f, g in enumerate(growing) for n in g.open]
            slot = np.full(trial.column.shape, -1, np.int64)
            for i, (f, n) in enumerate(slots):
                slot[f, n] = i

            # slots, in order, fall to the reducers in equal runs
            cut = np.linspace(0, len(slots), min(parts, len(slots)) + 1).astype(np.int64)

            def sums(task: Iterator[Block], since=tuple(since), trial=trial, slot=slot, cut=cut, turn=turn):
                total = None
                for b in task:
                    codes = b.codes(fill)
                    rest = b.label[None] - _advance(b, codes, since)
                    own = np.where(b.train & _drawn(b.key, rule, turn)[None], slot[np.arange(fits)[:, None], trial.nodes(codes)], -1)
                    f, r = np.nonzero(own >= 0)
                    if not len(f):
                        continue
                    if total is None:
                        total = np.zeros((2, int(cut[-1]) * width))
                    cells = (own[f, r] * width)[:, None] + starts[None] + codes[f, r]
                    total[1] += np.bincount(cells.ravel(), minlength=total.shape[1])
                    total[0] += np.bincount(cells.ravel(), np.repeat(rest[f, r], len(starts)), minlength=total.shape[1])
                if total is not None:
                    some = np.flatnonzero(total[1])
                    at = np.searchsorted(some, cut * width)
                    for p in range(len(cut) - 1):
                        own = some[at[p] : at[p + 1]]
                        if len(own):
                            yield p, (own - cut[p] * width, total[:, own])

            def splits(task: Iterator[tuple], allowed=allowed, cut=cut):
                summed: dict[int, np.ndarray] = {}
                for p, (cells, part) in task:
                    if p not in summed:
                        summed[p] = np.zeros((2, int(cut[p + 1] - cut[p]) * width))
                    summed[p][:, cells] += part
                for p, total in summed.items():
                    for i in range(int(cut[p + 1] - cut[p])):
                        one = total[:, i * width : (i + 1) * width]
                        if one[1].any():
                            yield int(cut[p]) + i, best_split(one, grid, allowed, rule)

            best = dict(blocks.mapPartitions(sums).partitionBy(len(cut) - 1, int).mapPartitions(splits).collect())
            for i, (f, n) in enumerate(slots):
                if i in best:
                    growing[f].found(n, *best[i])
            for g in growing:
                g.step()
        since.append(trees_of(growing, True))
        if len(since) == KEEP and turn + 1 < rule.rounds:
            path = os.path.join(folder, uuid.uuid4().hex)

            def moved(b: Block, since=tuple(since)) -> Block:
                b.now = _advance(b, b.codes(fill), since)
                return b
            blocks.map(moved).saveAsPickleFile(path, 1)
            blocks, since = spark.sparkContext.pickleFile(path, 1), []
            if written:
                discard(spark, written)
            written = path
    return blocks, since


def predict(rows: DataFrame, fits: Sequence[int], medians: Mapping[int, Mapping[str, float | None]], rule: Rule,
            left_out: str, keep: Sequence[str], fit: str = "fit", grid: Grid | None = None) -> DataFrame:
    """(``fit``, ``keep``..., pred) of every row and fit in the row's ``left_out`` (array of fits; null or
    empty: every fit trains on it). ``medians``: per fit the value that fills each lag's gaps. ``grid``:
    the bins, else those of the rows that some fit trains on."""
    spark = rows.sparkSession
    ship(spark)
    fits = list(fits)
    label = F.log1p(F.col(TARGET).cast("double"))
    out = F.coalesce(F.col(left_out), F.array().cast("array<int>"))
    if grid is None:
        of_fits = F.array_intersect(out, F.lit(fits).cast("array<int>"))
        grid = Grid.of(rows.where(label.isNotNull() & (F.size(of_fits) < len(fits))))
    numbers = _numbers()
    kept = rows.select(*keep)
    packed = rows.select(
        F.struct(*keep).alias("kept"), F.xxhash64(*keep).alias("key"), F.array(*[F.col(c).cast("string") for c in COHORT]).alias("levels"),
        F.array(*[numbers[c] for c in (*NUMBERS, *LAGS)]).alias("numbers"), label.alias("label"), out.alias("out"))
    fill = np.zeros((len(fits), len(LAGS)), np.int16)
    for j, c in enumerate(LAGS):
        values = [medians.get(f, {}).get(c) for f in fits]
        fill[:, j] = grid.code(FIRST_LAG + j, np.array([np.nan if v is None else v for v in values], float))
    most = max(BLOCK // max(len(fits), 1), 1)

    def pack(task: Iterator) -> Iterator[Block]:
        place = {f: i for i, f in enumerate(fits)}
        codes = [{v: i for i, v in enumerate(vs)} for vs in grid.levels]

        def block(held: list) -> Block:
            raw = np.array([[np.nan if v is None else v for v in r.numbers] for r in held], float)
            bins = np.zeros((len(held), len(COLUMNS)), np.int16)
            for c, of in enumerate(codes):
                bins[:, c] = [of.get(r.levels[c], len(of)) for r in held]
            for c in range(len(COHORT), len(COLUMNS)):
                bins[:, c] = grid.code(c, raw[:, c - len(COHORT)])
            known = np.array([r.label is not None and np.isfinite(r.label) for r in held])
            asked = np.zeros((len(fits), len(held)), bool)
            for i, r in enumerate(held):
                for f in r.out:
                    if f in place:
                        asked[place[f], i] = True
            label = np.array([r.label if k else 0.0 for r, k in zip(held, known)], float)
            return Block([tuple(r.kept) for r in held], np.array([r.key for r in held], np.int64).view(np.uint64), bins,
                         np.isnan(raw[:, -len(LAGS):]), np.round(label * ONE), ~asked & known[None], asked, np.zeros(asked.shape))

        held: list = []
        for r in task:
            held.append(r)
            if len(held) == most:
                yield block(held)
                held = []
        if held:
            yield block(held)

    folder = _run_folder(spark)
    first = os.path.join(folder, uuid.uuid4().hex)
    spread = packed.repartition(max(-(-rows.count() // most), 1), "key")
    spread.rdd.mapPartitions(pack).saveAsPickleFile(first, 1)
    blocks = spark.sparkContext.pickleFile(first, 1)
    means = blocks.map(lambda b: np.stack([(b.label[None] * b.train).sum(1), b.train.sum(1).astype(float)])).fold(
        np.zeros((2, len(fits))), np.add)
    start = np.round(np.divide(means[0], means[1], out=np.full(len(fits), np.nan), where=means[1] > 0))

    def begin(b: Block) -> Block:
        b.now = np.repeat(np.nan_to_num(start)[:, None], len(b.label), 1)
        return b
    last, since = grown(blocks.map(begin), grid, fill, start, rule, folder, spark)
    dead = np.isnan(start)

    def answers(b: Block) -> Iterator[tuple]:
        now = _advance(b, b.codes(fill), since) / ONE
        for f, r in zip(*np.nonzero(b.asked)):
            yield (fits[f], *b.kept[r], None if dead[f] else max(float(np.expm1(now[f, r])), 0.0))

    schema = T.StructType([T.StructField(fit, T.IntegerType()), *[T.StructField(s.name, s.dataType) for s in kept.schema],
                           T.StructField("pred", T.DoubleType())])
    return spark.createDataFrame(last.flatMap(answers), schema)


def fit_predict_trees(train: DataFrame, score: DataFrame, rule: Rule) -> DataFrame:
    """M5 / M6 for one train set: grain, revenue and ``pred`` of the score rows."""
    lags = lag_medians(train).first()
    names = [MONTH, *COHORT, TARGET, STREAMS, *LAGS]
    rows = (train.select(*names, F.array().cast("array<int>").alias("_out"))
            .unionByName(score.select(*names, F.array(F.lit(0)).alias("_out"))))
    return predict(rows, [0], {0: {c: lags[f"_med_{c}"] for c in LAGS}}, rule, "_out", [MONTH, *COHORT, TARGET], "_fit").drop("_fit")


def held_predictions(pool: DataFrame, held: DataFrame, repeat: str, medians: Mapping[int, Mapping[str, float | None]],
                     repeats: int, rule: Rule) -> DataFrame:
    """(repeat, grain, revenue, pred) of every repeat's held-out rows, all repeats' trees grown together."""
    key = [MONTH, *COHORT]
    out = held.groupBy(*key).agg(F.collect_set(F.col(repeat).cast("int")).alias("_out"))
    rows = lookup_join(pool, out, key, "left")
    return predict(rows, list(range(1, repeats + 1)), medians, rule, "_out", [*key, TARGET], repeat)
