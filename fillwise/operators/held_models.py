"""Linear models of every backtest repeat from partition-summed Gram matrices (B1, M3, M4).

A repeat trains on the pool without its held-out rows. Each row is one vector ``z``: a one, the
cohort one-hots (every level), calendar and streams, the lags with 0 for a gap, a gap mark for
each lag, and revenue. Tasks sum ``z z'`` over their rows; a repeat's matrix is the pool's less
that of its held-out rows, so the pool is read once and never copied. Filling the gaps with the
repeat's own train median is a linear map of ``z`` (lag + median * mark), so it is applied to
the summed matrix. Both models, and the scales of the nearest-neighbour search
(``fillwise.operators.knn_held``), come from the same matrices.

Numbers are shifted by their pool mean first, which no fit with an intercept notices, so the
subtraction loses no digits that matter. Defined cases: a repeat without train rows predicts
null; a lag that no train row has is filled with its pool mean; rows need streams and revenue,
as known rows have. The driver holds one matrix a repeat: levels squared, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwise.config import COHORT, MONTH, STREAMS, TARGET
from fillwise.functions.joins import lookup_join
from fillwise.functions.quantiles import quantiles_without
from fillwise.functions.safe import non_negative
from fillwise.operators.ml import LAGS, _levels
from fillwise.operators.ml import lag_medians as base_medians
from fillwise.session import ship

NUMBERS = ("month_num", "quarter", STREAMS, "log_streams")
#: A variance below this share of the mean square is none.
FLAT = 1e-12


def _numbers() -> dict[str, Column]:
    """Calendar, streams and lags of a panel row, as doubles."""
    streams = F.col(STREAMS).cast("double")
    out = {"month_num": F.month(MONTH), "quarter": F.quarter(MONTH), STREAMS: streams, "log_streams": F.log1p(streams)}
    out.update({c: F.col(c) for c in LAGS})
    return {name: c.cast("double") for name, c in out.items()}


def _one_hot(column: Column, levels: list[str]) -> Column:
    return F.transform(F.array(*[F.lit(v) for v in levels]), lambda v: F.coalesce((v == column).cast("double"), F.lit(0.0)))


@dataclass(frozen=True)
class Design:
    """Places of ``z``: one, one-hots, numbers, lags, marks, revenue."""

    levels: tuple[tuple[str, str], ...]
    shift: Mapping[str, float]

    @classmethod
    def of(cls, pool: DataFrame) -> Design:
        """Levels and means of the pool."""
        levels = tuple((c, v) for c, vs in _levels(pool).items() for v in vs)
        means = pool.agg(*[F.avg(c).alias(name) for name, c in _numbers().items()]).first()
        return cls(levels, {name: float(means[name] or 0.0) for name in (*NUMBERS, *LAGS)})

    @property
    def size(self) -> int:
        return 1 + len(self.levels) + len(NUMBERS) + 2 * len(LAGS) + 1

    @property
    def features(self) -> list[str]:
        """Names of the tree and neighbour features."""
        return [f"{c}={v}" for c, v in self.levels] + [*NUMBERS, *LAGS]

    @property
    def linear(self) -> list[int]:
        """Places among ``features`` of the linear ones: no first level of a column, no logarithm."""
        firsts = {next(i for i, (c, _) in enumerate(self.levels) if c == name) for name in {c for c, _ in self.levels}}
        return [i for i, name in enumerate(self.features) if i not in firsts and name != "log_streams"]

    def vector(self) -> Column:
        numbers = _numbers()
        parts = [F.array(F.lit(1.0))]
        for name in COHORT:
            own = [v for c, v in self.levels if c == name]
            if own:
                parts.append(_one_hot(F.col(name), own))
        parts.append(F.array(*[numbers[n] - F.lit(self.shift[n]) for n in NUMBERS]))
        parts.append(F.array(*[F.coalesce(numbers[n] - F.lit(self.shift[n]), F.lit(0.0)) for n in LAGS]))
        parts.append(F.array(*[numbers[n].isNull().cast("double") for n in LAGS], F.col(TARGET).cast("double")))
        return F.concat(*parts)

    def filled(self, medians: Mapping[str, float | None]) -> np.ndarray:
        """The map from ``z`` to the features, lag gaps filled with ``medians``."""
        p, lag, mark = len(self.features), self.size - 1 - 2 * len(LAGS), self.size - 1 - len(LAGS)
        out = np.zeros((p, self.size))
        out[np.arange(p), 1 + np.arange(p)] = 1.0
        for j, name in enumerate(LAGS):
            if medians.get(name) is not None:
                out[lag - 1 + j, mark + j] = medians[name] - self.shift[name]
        return out


def lag_medians(pool: DataFrame, held: DataFrame, repeat: str, copies: Callable[[DataFrame], DataFrame]) -> dict[int, dict]:
    """Per repeat, the train median of each lag, ranked under deletion in the pool's slices."""
    def stacked(df: DataFrame, own: list[str]) -> DataFrame:
        lags = [F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in LAGS]
        return df.select(*own, F.explode(F.array(*lags)).alias("_s")).select(*own, "_s.*")

    rows = quantiles_without(stacked(pool, []), stacked(held, [repeat]), "_v", {"_m": 0.5}, copies, repeat, ["_col"]).collect()
    out: dict[int, dict] = {}
    for r in rows:  # repeats times lags
        out.setdefault(r[repeat], {})[r["_col"]] = r["_m"]
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def grams(rows: DataFrame, size: int) -> dict[int, np.ndarray]:
    """Sum of ``z z'`` per ``part`` of (part int, z array<double>), summed in each task first."""
    at = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                part, z = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
                for r in np.unique(part):
                    own = z[part == r]
                    got[int(r)] = got.get(int(r), 0.0) + own.T @ own
        for r, m in got.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at[0]), r, np.int32)), pa.array(np.arange(len(at[0]), dtype=np.int32)), pa.array(m[at])],
                ["part", "i", "v"])

    out: dict[int, np.ndarray] = {}
    summed = rows.mapInArrow(sums, "part int, i int, v double").groupBy("part", "i").agg(F.sum("v").alias("v"))
    for r in summed.collect():  # parts times places squared
        m = out.setdefault(r["part"], np.zeros((size, size)))
        a, b = at[0][r["i"]], at[1][r["i"]]
        m[a, b] = m[b, a] = r["v"]
    return out


def solve(gram: np.ndarray, features: np.ndarray, alpha: float | None) -> np.ndarray | None:
    """Coefficients over ``z``: least squares (of minimum norm over unit variances), or with ``alpha`` times the squared
    coefficients as penalty, the intercept free."""
    n = gram[0, 0]
    if n <= 0:
        return None
    mean, mean_y = features @ gram[:, 0] / n, gram[0, -1] / n
    g = features @ gram @ features.T - n * np.outer(mean, mean)
    xy = features @ gram[:, -1] - n * mean * mean_y
    if alpha is None:
        # to unit variances first: the columns' sizes differ by more than a double's digits
        scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
        w = np.linalg.pinv(g / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (xy / scale) / scale
    else:
        w = np.linalg.solve(g + alpha * np.eye(len(g)), xy)
    out = features.T @ w
    out[0] += mean_y - mean @ w
    return out


@dataclass(frozen=True)
class HeldFits:
    """What all repeats' models need of the pool: the design, each repeat's train matrix and
    lag medians (repeat 0: the whole pool), bounded by repeats and levels."""

    design: Design
    train: Mapping[int, np.ndarray]
    medians: Mapping[int, dict]


def fit_pool(pool: DataFrame, held: DataFrame, repeat: str, repeats: int, copies: Callable[[DataFrame], DataFrame]) -> HeldFits:
    """One reading of the pool and one of the held-out rows, for every repeat and model."""
    ship(pool.sparkSession)
    design = Design.of(pool)
    z = design.vector().alias("z")
    got = grams(pool.select(F.lit(0).alias("part"), z).unionByName(held.select(F.col(repeat).cast("int").alias("part"), z)), design.size)
    none = np.zeros((design.size, design.size))
    train = {r: got.get(0, none) - (got.get(r, none) if r else none) for r in range(repeats + 1)}
    return HeldFits(design, train, lag_medians(pool, held, repeat, copies))


def predict_linear(fits: HeldFits, held: DataFrame, repeat: str, models: Mapping[str, float | None]) -> DataFrame:
    """(model, repeat, grain, actual, pred) of the held-out rows, for models name -> penalty (None: least squares)."""
    rows = []
    for r, gram in fits.train.items():
        features = fits.design.filled(fits.medians.get(r, {}))[fits.design.linear]
        for name, alpha in models.items():
            w = solve(gram, features, alpha) if r else None
            if w is not None:
                rows.append((r, name, [float(v) for v in w]))
    coefs = held.sparkSession.createDataFrame(rows, f"{repeat} int, model string, _w array<double>")
    names = held.select("*", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    out = lookup_join(names.withColumn("_z", fits.design.vector()), coefs, [repeat, "model"], "left", bound=len(rows))
    dot = F.aggregate(F.zip_with("_z", "_w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return out.select("model", repeat, MONTH, *COHORT, TARGET, non_negative(dot).alias("pred"))


def revenue_moments(pool: DataFrame) -> DataFrame:
    """(feature, mean_product): per row, the summed product of each place of ``z`` (shifts undone, lag
    gaps 0) with revenue, from the Gram matrix that the fits use; no rows give no row."""
    ship(pool.sparkSession)
    design = Design.of(pool)
    m = grams(pool.select(F.lit(0).alias("part"), design.vector().alias("z")), design.size).get(0)
    names = ["one", *design.features, *[f"{c} missing" for c in LAGS]]
    rows = []
    if m is not None:
        plain = m[-1].copy()
        for n in NUMBERS:
            plain[names.index(n)] += design.shift[n] * m[-1, 0]
        for n in LAGS:
            plain[names.index(n)] += design.shift[n] * (m[-1, 0] - m[-1, names.index(f"{n} missing")])
        rows = [(name, float(plain[i] / m[0, 0])) for i, name in enumerate(names)]
    return pool.sparkSession.createDataFrame(rows, "feature string, mean_product double")


def residuals(pool: DataFrame, models: Mapping[str, float | None]) -> DataFrame:
    """(model, feature, residual): each fit's normal equations on its own train rows, from a second
    reading of them: the sum of feature times error, less the penalty, over the sum of its
    parts' sizes (0: the fit is exact). Errors are before clipping at 0."""
    ship(pool.sparkSession)
    design = Design.of(pool)
    gram = grams(pool.select(F.lit(0).alias("part"), design.vector().alias("z")), design.size).get(0, np.zeros((design.size,) * 2))
    lags = base_medians(pool).first()
    fill = design.filled({c: lags[f"_med_{c}"] for c in LAGS})[design.linear]
    names = [design.features[i] for i in design.linear]
    fits = {model: w for model, alpha in models.items() if (w := solve(gram, fill, alpha)) is not None}
    y = F.element_at("z", -1)
    errors = [F.struct(F.lit(model).alias("model"), (y - F.aggregate(
        F.zip_with("z", F.lit([float(v) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)).alias("err")) for model, w in fits.items()]
    rows = []
    if fits:
        table = pool.select(design.vector().alias("z")).select("z", y.alias("y"), F.explode(F.array(*errors)).alias("e"))
        long = table.select("e.model", "e.err", "y", F.posexplode("z").alias("i", "v"))
        sums = long.groupBy("model", "i").agg(F.sum(F.col("v") * F.col("err")).alias("s"),
                                              F.sum(F.abs("v") * (F.abs("err") + F.abs("y"))).alias("a"))
        found = {(r["model"], r["i"]): (r["s"], r["a"]) for r in sums.collect()}  # models times places
        for model, w in fits.items():
            s, a = (np.array([found[model, i][k] for i in range(design.size)]) for k in (0, 1))
            off = np.abs(fill @ s - (models[model] or 0.0) * _slopes(w, fill)) / np.maximum(np.abs(fill) @ a, 1e-300)
            rows += [(model, name, float(v)) for name, v in zip(names, off)]
    return pool.sparkSession.createDataFrame(rows, "model string, feature string, residual double")


def _slopes(w: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Feature coefficients back from those over ``z`` (each feature has a place of its own)."""
    return w[1:][[int(np.flatnonzero(f[1:])[0]) for f in features]]
