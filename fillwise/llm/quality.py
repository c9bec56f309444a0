"""Quality classifier: ridge regression on random Fourier features of document statistics,
calibrated by isotonic regression.

Statistics of the whole text (byte classes, word and line shapes, repetition) are
standardised; seeded random cosines of them approximate a Gaussian kernel. Training tasks
return only the sums of their normal equations, by fold; the driver adds these few matrices,
solves one small ridge system a fold and one over all, and calibrates on the scores that
each row gets from the system that did not see it. Isotonic regression gives the
probability of label 1; between the pooled blocks it is interpolated, so scores keep order.

Labels come from rows outside the held-out fold (crc32 of the id's text mod 5 is 0). At most
about ``TRAIN_ROWS`` labelled ids, chosen by a hash, fit the model, and where ids repeat about that
many of their rows, by a hash of id and text. Only these are measured. Rows of equal statistics,
label and fold are one with a weight, so no key is hot. The scoring covers every row and
depends on the text alone.

Rows: null or empty texts have the statistics of an empty text and are scored; ids may be
null or repeated (each row is scored; held-out is taken of an empty id); several labels of
one id are averaged, null labels ignored. Without any usable label every score is 0.5.
Output columns are named by the caller, so clashing names do not arise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fillwise.llm import textblocks
from fillwise.llm.common import ship, stored

#: Labelled rows that fit the model at most.
TRAIN_ROWS = 60_000
FEATURES = 256
#: Kernel width, in standard deviations of the statistics times the root of their count.
WIDTH = 0.9
RIDGE = 1e-3
FOLDS = 3
SUM_TASKS = 6
SEED = 7
THRESHOLD = 0.3

_CLASSES = ["upper", "lower", "digit", "high", "space", "line", "bar", "bang", "symbol", "stop", "other"]
_CLASS = np.full(256, _CLASSES.index("other"), np.int64)
for _i in range(256):
    _c = chr(_i)
    for _name, _is in (("upper", 65 <= _i <= 90), ("lower", 97 <= _i <= 122), ("digit", 48 <= _i <= 57), ("high", _i >= 128),
                       ("space", _c in " \t\r\x0b\x0c"), ("line", _c == "\n"), ("bar", _c == "|"), ("bang", _c in "!?"),
                       ("symbol", _c in "#$%&*@^~=<>+_\\/{}[]`"), ("stop", _c in ".,;:")):
        if _is:
            _CLASS[_i] = _CLASSES.index(_name)
N_STATS = len(_CLASSES) + 9


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    out = np.zeros((len(column), N_STATS))
    for b in textblocks.blocks(column):
        rows = out[b.first : b.first + b.texts]
        size = np.diff(b.bounds)
        owner = np.repeat(np.arange(b.texts), size)
        k = len(_CLASSES)
        counts = np.bincount(owner * k + _CLASS[b.data], minlength=b.texts * k).reshape(b.texts, k)
        w = textblocks.words(b)
        n = np.maximum(textblocks.per_text(b, w.text), 1)
        length = w.end - w.start
        first = _CLASS[b.data[w.start]] if len(w.start) else w.start
        again = np.zeros(len(w.start), bool)
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
        line = np.cumsum(b.data == 10)[w.start] if len(w.start) else w.start
        opens = np.ones(len(line), bool)
        opens[1:] = (line[1:] != line[:-1]) | (w.text[1:] != w.text[:-1])
        lead = np.flatnonzero(opens)
        with np.errstate(over="ignore"):
            line_hash = np.add.reduceat(w.hash, lead) if len(lead) else w.hash
        line_text = w.text[lead]
        rows[:, :k] = counts / np.maximum(size, 1)[:, None]
        rows[:, k] = np.log1p(n)
        rows[:, k + 1] = np.log1p(textblocks.per_text(b, w.text, length) / n)
        rows[:, k + 2] = textblocks.per_text(b, w.text, again) / n
        rows[:, k + 3] = np.log1p(_distinct(b, w.text, w.hash)) / np.log1p(n)
        rows[:, k + 4] = _distinct(b, line_text, line_hash) / np.maximum(textblocks.per_text(b, line_text), 1)
        rows[:, k + 5] = textblocks.per_text(b, w.text, first == _CLASSES.index("upper")) / n
        rows[:, k + 6] = textblocks.per_text(b, w.text, length <= 2) / n
        rows[:, k + 7] = np.log1p(textblocks.per_text(b, line_text) / n)
        rows[:, k + 8] = np.log1p(size)
    return out


def _distinct(b: textblocks.Block, owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    order = np.lexsort((h, owner))
    o, x = owner[order], h[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1])
    return np.bincount(o[new], minlength=b.texts)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    x: np.ndarray  # calibration: raw score -> probability
    p: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(0, 1 / (WIDTH * np.sqrt(N_STATS)), (N_STATS, FEATURES))
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + phase), np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.x):
            return np.full(len(stats), 0.5)
        raw = self.features(stats) @ self.beta
        # a thousandth of the score orders what the calibration holds to be equal
        return 0.999 * np.interp(raw, self.x, self.p) + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30)))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and means of the blocks, both ascending."""
    order = np.argsort(x, kind="stable")
    weight = np.ones(len(x)) if weight is None else weight
    sums: list[float] = []
    sizes: list[float] = []
    centres: list[float] = []
    for xi, yi, wi in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        sums.append(yi * wi)
        sizes.append(wi)
        centres.append(xi * wi)
        while len(sums) > 1 and sums[-2] * sizes[-1] >= sums[-1] * sizes[-2]:
            s, n, c = sums.pop(), sizes.pop(), centres.pop()
            sums[-1] += s
            sizes[-1] += n
            centres[-1] += c
    size = np.array(sizes)
    return np.array(centres) / size, np.array(sums) / size


def held_out(key: str, folds: int, of: int) -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == of


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(statistics, label, fold, weight) of some rows."""
    stats = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)
    y, fold, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
    for i in range(0, len(y), 2000):
        yield stats[i : i + 2000], y[i : i + 2000], fold[i : i + 2000], weight[i : i + 2000]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on rows that have a label and are not held out."""
    ship(docs.sparkSession)
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key, 5, 0))
             .groupBy(F.col(key).alias("_id")).agg(F.avg(F.col(label).cast("double")).alias("y")))
    n = known.count()
    if n > train_rows:  # the same rows in every run: those whose hash is low
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / n))

    # about train_rows ids at most, so they are broadcast, and only their texts are measured
    at = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    chosen = at.join(F.broadcast(known.select(F.col("_id").cast("long").alias("_id"), "y")), "_id")
    m = chosen.count()  # reads ids alone
    if m > train_rows:
        chosen = chosen.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(1 << 30)) < int((1 << 30) * train_rows / m))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(
                stats.ravel(), N_STATS).cast(pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["stats", "y", "fold"])

    measured = chosen.select("_text", "y", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold")).mapInArrow(
        measure, "stats array<double>, y double, fold int")
    same = measured.groupBy("stats", "y", "fold").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    train = stored(same.repartition(SUM_TASKS, "stats", "y", "fold").sortWithinPartitions("stats", "y", "fold"))
    empty = Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * N_STATS + 1)
        for batch in batches:
            for stats, _, _, weight in _chunks(batch):
                total += np.concatenate([[weight.sum()], weight @ stats, weight @ stats**2])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    total = sum((np.frombuffer(r["sums"]) for r in train.mapInArrow(moments, "sums binary").collect()),
                np.zeros(2 * N_STATS + 1))
    if total[0] == 0:
        return empty
    mean = total[1 : N_STATS + 1] / total[0]
    scale = np.sqrt(np.maximum(total[N_STATS + 1 :] / total[0] - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), empty.beta, empty.x, empty.p)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = FEATURES + 1
        sums = np.zeros((FOLDS, d, d + 1))
        for batch in batches:
            for stats, y, fold, weight in _chunks(batch):
                x = model.features(stats)
                for f in range(FOLDS):
                    xf = x[fold == f]
                    sums[f] += (xf * weight[fold == f][:, None]).T @ np.hstack([xf, y[fold == f][:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()])], ["sums"])

    shape = (FOLDS, FEATURES + 1, FEATURES + 2)
    sums = np.zeros(shape)
    for r in train.mapInArrow(normal, "sums binary").collect():
        sums += np.frombuffer(r["sums"]).reshape(shape)

    def solve(s: np.ndarray) -> np.ndarray:
        a, b = s[:, :-1], s[:, -1]
        return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1) / FEATURES * np.eye(len(a)), b)

    betas = [solve(sums.sum(0) - sums[f]) for f in range(FOLDS)]

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stats, y, fold, weight in _chunks(batch):
                x = model.features(stats)
                raw = np.choose(fold, [x @ beta for beta in betas])
                yield pa.RecordBatch.from_arrays([pa.array(raw), pa.array(y), pa.array(weight)], ["raw", "y", "weight"])

    # at most about TRAIN_ROWS triples of numbers
    pairs = np.array([tuple(r) for r in train.mapInArrow(unseen, "raw double, y double, weight double").collect()])
    model.beta = solve(sums.sum(0))
    model.x, model.p = isotonic(pairs[:, 0], pairs[:, 1], pairs[:, 2])
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score column; every other column passes through."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pa.array(model.score(statistics(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns, p], [*batch.schema.names, score])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score, DoubleType())]))
