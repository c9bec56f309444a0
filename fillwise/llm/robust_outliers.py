"""Quality rules by robust multivariate outliers: minimum covariance determinant (MCD).

Every whole text gives counts (words, characters, symbols, lines and repetitions) and from
them a vector of five transformed statistics: logarithms of the length and of a
steadied mean word length, and arcsine roots of the shares of symbols, repeated lines and
repeated words. Per (language, source) the MCD estimate is the centre and covariance of the
half of the vectors with the least determinant. It is reached by concentration steps over all
vectors of the group from two deterministic starts: medians with interquartile
scales, and the covariance of vectors squashed by tanh. A step is one aggregation: sums of vectors and
products per (group, start, bin of the distance), the bins being 32 an octave; the nearest bins
that hold half of the vectors make the next estimate. The start with the smaller determinant
wins, and is reweighted once over the vectors within its 97.5% ellipsoid. A document is rejected if its
squared Mahalanobis distance exceeds the chi-square quantile that one of a million regular vectors exceeds.

Equal counts within a group weigh once, so copies cannot outvote other documents. Each
covariance is widened by a fixed resolution of the statistics (``RESOLUTION``), as most texts hold no symbol at all
and a variance of zero would reject every text with one. A group of fewer than ``LEAST``
different vectors takes the estimate of its language, else that of all documents; below
that, nothing is rejected but by the base rule.

Base rule: fewer than 10 words, or over 20% of the words in five-word windows that occur
twice or more in the text. Documents that fail it take no part in the estimates.

Rows: null and empty texts have no words and fail the base rule; null languages and sources
are values of their own; repeated rows are each judged. All columns pass through ``judged``
beside one struct, so clashing names do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fillwise.llm import textblocks
from fillwise.llm.common import ship, small_side, stored

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True

DIMS = 5
#: Resolution of the transformed statistics, as standard deviations.
RESOLUTION = (0.3, 0.03, 0.02, 0.1, 0.1)
#: Different vectors that a group needs for an estimate of its own.
LEAST = 100
#: Share of regular vectors that lie beyond the limit, and within the ellipsoid of the reweighting.
BEYOND, WITHIN = 1e-6, 0.975
#: Concentration steps at most, and the change of the log determinant that ends them.
STEPS, STILL = 12, 0.05
#: Bins of the squared distance in an octave, and of a statistic in a unit.
BINS, GRAIN = 32, 64
STARTS = ("scale", "tanh")

MIN_WORDS, REPEAT_PERCENT = 10, 20


# --- statistics of texts

def counts(column: pa.Array) -> np.ndarray:
    """One row of ``COUNTS`` per text."""
    out = np.zeros((len(column), len(COUNTS)), np.int64)
    for b in textblocks.blocks(column):
        w = textblocks.words(b)
        rows = out[b.first : b.first + b.texts]
        owner = np.repeat(np.arange(b.texts), np.diff(b.bounds))
        rows[:, 0] = textblocks.per_text(b, w.text)
        # a code point is a byte that continues no other
        rows[:, 1] = textblocks.per_text(b, owner[~textblocks.IS_SPACE[b.data] & (b.data & 0xC0 != 0x80)])
        rows[:, 2] = textblocks.per_text(b, owner[SYMBOLS[b.data]])
        rows[:, 3], rows[:, 5] = _lines(b, w)
        rows[:, 4] = _repeated(b, w)
    return out


def _lines(b: textblocks.Block, w: textblocks.Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines equal to an earlier one of their text, and all lines, counting those with a word."""
    n = len(b.data)
    breaks = np.flatnonzero(b.data == 10)
    start = np.unique(np.concatenate([b.bounds[:-1], breaks + 1]))
    start = start[start < n]
    text = np.searchsorted(b.bounds, start, "right") - 1
    end = np.minimum(np.append(breaks, n)[np.searchsorted(breaks, start)], b.bounds[text + 1])
    holds = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, text = start[holds], end[holds], text[holds]
    h = textblocks.hashes(b.data, start, end)
    order = np.lexsort((h, text))
    again = np.zeros(len(order), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    return textblocks.per_text(b, text[order][again]), textblocks.per_text(b, text)


def _repeated(b: textblocks.Block, w: textblocks.Words) -> np.ndarray:
    """Words in windows that occur twice or more in their text."""
    n = len(w.hash) - WINDOW + 1
    if n <= 0:
        return np.zeros(b.texts, np.int64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            h = textblocks.mixed(h * np.uint64(31) + w.hash[k : n + k])
    first = np.flatnonzero(w.text[:n] == w.text[WINDOW - 1 :])  # windows within one text
    order = first[np.lexsort((h[first], w.text[first]))]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (h[order][1:] == h[order][:-1]) & (w.text[order][1:] == w.text[order][:-1])
    twice = order[same[1:] | same[:-1]]
    edge = np.zeros(len(w.hash) + 1, np.int64)
    edge[twice] += 1
    np.subtract.at(edge, twice + WINDOW, 1)
    return textblocks.per_text(b, w.text[np.cumsum(edge[:-1]) > 0])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document's row as a struct) and its ``COUNTS``."""
    ship(docs.sparkSession)
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = counts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c[:, i]) for i in range(len(COUNTS)))], ["row", *COUNTS])

    return packed.mapInArrow(run, StructType([packed.schema["row"], *(StructField(c, LongType()) for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics, of documents with words."""
    def share(part: str, whole: str, steady: int) -> Column:
        return F.asin(F.sqrt(F.col(part) / (F.col(whole) + F.lit(float(steady)))))

    return [F.log("n_words"), F.log((F.col("word_chars") + 100.0) / (F.col("n_words") + 20.0)),
            share("n_symbols", "word_chars", 1), share("n_dup_lines", "n_lines", 10), share("n_repeat_words", "n_words", 50)]


# --- chi-square

def chi2_cdf(x: float, k: float) -> float:
    """Regularised lower incomplete gamma function, by its series or continued fraction."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 0.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-17 * total:
            n += 1
            term *= x / n
            total += term
        return front * total
    c, d = 1e300, 1 / (x + 1 - a)
    h, b = d, x + 1 - a
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - front * h


def chi2_quantile(p: float, k: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def widening(share: float) -> float:
    """What makes the covariance of the nearest ``share`` of normal vectors that of all."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


LIMIT = chi2_quantile(1 - BEYOND, DIMS)


# --- estimates

X = [f"x{i}" for i in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_SUMS = ["n", *X, *(f"p{i}{j}" for i, j in _PAIRS)]


def _sums(x: list[Column], weight: Column | None = None) -> list[Column]:
    """Sums of vectors and of their products."""
    def total(c: Column, name: str) -> Column:
        return F.sum(c if weight is None else F.when(weight, c)).alias(name)

    one = F.lit(1).cast("double")
    return [total(one, "n"), *(total(c, n) for c, n in zip(x, X)),
            *(total(x[i] * x[j], f"p{i}{j}") for i, j in _PAIRS)]


def _distance(centre: str, precision: str) -> Column:
    """Squared Mahalanobis distance of x to an estimate."""
    d = [F.col(x) - F.col(centre)[i] for i, x in enumerate(X)]
    terms = [d[i] * d[j] * F.col(precision)[i * DIMS + j] * F.lit(1.0 if i == j else 2.0) for i, j in _PAIRS]
    return sum(terms[1:], terms[0])


def _estimates(sums: DataFrame, factor: Column) -> DataFrame:
    """Centre, precision and log determinant of each row of sums; ``factor`` widens the covariance."""
    keys = [c for c in sums.columns if c not in _SUMS]
    ready = sums.select(*keys, F.array(*_SUMS).alias("sums"), factor.alias("factor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_SUMS))
            wide = batch.column(len(keys) + 1).to_numpy(zero_copy_only=False)
            n = np.maximum(s[:, :1], 1)
            mean = s[:, 1 : DIMS + 1] / n
            cov = np.zeros((len(s), DIMS, DIMS))
            for c, (i, j) in enumerate(_PAIRS):
                cov[:, i, j] = cov[:, j, i] = s[:, DIMS + 1 + c] / n[:, 0] - mean[:, i] * mean[:, j]
            cov = cov * wide[:, None, None] + np.diag(np.square(RESOLUTION))
            centre, precision = _lists(mean), _lists(np.linalg.inv(cov).reshape(-1, DIMS * DIMS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], centre, precision, pa.array(np.linalg.slogdet(cov)[1])],
                [*keys, "centre", "precision", "logdet"])

    fields = StructType([*(sums.schema[k] for k in keys), *StructType.fromDDL(
        "centre array<double>, precision array<double>, logdet double").fields])
    return ready.mapInArrow(run, fields)


def _lists(a: np.ndarray) -> pa.Array:
    # rounded, as sums of doubles depend in their last digits on the order of the rows
    return pa.FixedSizeListArray.from_arrays(np.round(a, 9).ravel(), a.shape[1]).cast(pa.list_(pa.float64()))


def cells(lang: str = "lang", source: str = "source") -> list[Column]:
    """Keys of a document's group, of its language and of all; null differs from any value."""
    own = [F.col(lang).alias("l"), F.col(source).alias("s")]
    return [F.concat(F.lit(str(i)), F.to_json(F.struct(F.lit(0).alias("z"), *own[: 2 - i]))) for i in range(3)]


def _near(sums: DataFrame, keys: list[str], upto: Column) -> DataFrame:
    """Sums over the nearest bins that together hold ``upto`` vectors of ``all``."""
    order = Window.partitionBy(*keys).orderBy("bin")
    every = Window.partitionBy(*keys)
    x = sums.withColumn("_before", F.sum("n").over(order) - F.col("n")).withColumn("all", F.sum("n").over(every))
    x = x.where(F.col("_before") < upto)
    return x.groupBy(*keys).agg(F.max("all").alias("all"), *[F.sum(c).alias(c) for c in _SUMS])


def _quartiles(vectors: DataFrame) -> DataFrame:
    """Median and scale of each statistic in each cell, by bins of 1 / ``GRAIN``."""
    rows = vectors.select("cell", F.posexplode(F.array(*X)).alias("i", "x"))
    h = rows.groupBy("cell", "i", F.floor(F.col("x") * GRAIN).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("cell", "i").orderBy("bin")
    h = h.withColumn("_upto", F.sum("n").over(order)).withColumn("_all", F.sum("n").over(Window.partitionBy("cell", "i")))
    q = [F.min(F.when(F.col("_upto") >= F.col("_all") * p, (F.col("bin") + 0.5) / GRAIN)).alias(f"q{k}")
         for k, p in enumerate((0.25, 0.5, 0.75))]
    q = h.groupBy("cell", "i").agg(*q)
    fixed = F.array(*map(F.lit, RESOLUTION))[F.col("i")]
    scale = F.greatest((F.col("q2") - F.col("q0")) / 1.349, fixed)
    got = q.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("i", F.col("q1").alias("mid"), scale.alias("scale")))).alias("q"))
    return got.select("cell", F.transform("q", lambda r: r["mid"]).alias("mid"), F.transform("q", lambda r: r["scale"]).alias("scale"))


def _starts(vectors: DataFrame) -> DataFrame:
    """The two first estimates of every cell: cell, start, centre, precision, logdet."""
    q = stored(_quartiles(vectors))
    both = vectors.join(small_side(q), "cell")
    y = [F.tanh((F.col(x) - F.col("mid")[i]) / F.col("scale")[i]) for i, x in enumerate(X)]
    squashed = both.groupBy("cell").agg(*_sums(y)).join(q, "cell")
    # covariances in units of the scales; tanh keeps about 0.39 of a normal variance
    unit = F.lit(1 / 0.394)

    def cov(i: int, j: int) -> Column:
        n = F.col("n")
        return unit * (F.col(f"p{i}{j}") / n - F.col(X[i]) * F.col(X[j]) / (n * n)) * F.col("scale")[i] * F.col("scale")[j]

    def sums(start: str, spread) -> list[Column]:
        # one vector's sums with the wanted centre and covariance
        mid = [F.col("mid")[i] for i in range(DIMS)]
        return [F.col("cell"), F.lit(start).alias("start"), F.lit(1.0).alias("n"), *(m.alias(x) for m, x in zip(mid, X)),
                *((spread(i, j) + mid[i] * mid[j]).alias(f"p{i}{j}") for i, j in _PAIRS)]

    plain = squashed.select(*sums("scale", lambda i, j: F.pow(F.col("scale")[i], F.lit(2.0)) if i == j else F.lit(0.0)))
    return _estimates(plain.unionByName(squashed.select(*sums("tanh", cov))), F.lit(1.0))


def estimates(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """cell, centre, precision: the reweighted MCD estimate of every group, language and of all
    that hold ``least`` different vectors. rows: ``lang``, ``source`` and ``COUNTS``."""
    ship(rows.sparkSession)
    vectors = (rows.where(~base_failed()).select(F.explode(F.array(*cells())).alias("cell"), *COUNTS)
               .groupBy("cell", *COUNTS).agg(F.lit(1).alias("_one"))
               .select("cell", *(c.alias(x) for c, x in zip(vector(), X))))
    vectors = stored(vectors)
    large = stored(vectors.groupBy("cell").count().where(F.col("count") >= least).select("cell"))
    vectors = stored(vectors.join(small_side(large), "cell", "left_semi"))
    now = stored(_starts(vectors))
    half = F.ceil((F.col("all") + DIMS + 1) / 2)
    widen = F.lit(widening(0.5))

    def binned(est: DataFrame, keys: list[str]) -> DataFrame:
        d = _distance("centre", "precision")
        return (vectors.join(small_side(est), "cell").withColumn("_d", d)
                .groupBy(*keys, F.floor(F.log2(F.greatest("_d", F.lit(1e-9))) * BINS).alias("bin"))
                .agg(*_sums([F.col(x) for x in X])))

    for _ in range(STEPS):
        after = stored(_estimates(_near(binned(now, ["cell", "start"]), ["cell", "start"], half).drop("all"), widen))
        moved = after.alias("a").join(now.alias("b"), ["cell", "start"]).agg(F.max(F.abs(F.col("a.logdet") - F.col("b.logdet")))).first()[0]
        now = after
        if moved is None or moved < STILL:
            break
    least_det = now.groupBy("cell").agg(F.min(F.struct("logdet", "start", "centre", "precision")).alias("e")).select("cell", "e.centre", "e.precision")
    within = chi2_quantile(WITHIN, DIMS)
    kept = (vectors.join(small_side(stored(least_det)), "cell").where(_distance("centre", "precision") <= within)
            .groupBy("cell").agg(*_sums([F.col(x) for x in X])))
    return stored(_estimates(kept, F.lit(widening(WITHIN))).select("cell", "centre", "precision"))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """``row`` (the document's row), ``COUNTS``, base_failed, distance (squared; null where
    there is no estimate) and kept."""
    rows = stored(measured(docs, text))
    flat = rows.select(F.col(f"row.`{lang}`").alias("lang"), F.col(f"row.`{source}`").alias("source"), *COUNTS)
    est = estimates(flat, least)
    # the finest estimate of each group
    groups = flat.select("lang", "source").distinct().select(F.posexplode(F.array(*cells())).alias("level", "cell"), cells()[0].alias("own"))
    choice = (groups.join(est, "cell").groupBy("own").agg(F.min(F.struct("level", "centre", "precision")).alias("e"))
              .select("own", "e.centre", "e.precision"))
    x = rows.withColumn("own", F.concat(F.lit("0"), F.to_json(F.struct(
        F.lit(0).alias("z"), F.col(f"row.`{lang}`").alias("l"), F.col(f"row.`{source}`").alias("s")))))
    x = x.join(small_side(stored(choice)), "own", "left").select(
        "row", *COUNTS, base_failed().alias("base_failed"), "centre", "precision", *(c.alias(n) for c, n in zip(vector(), X)))
    distance = F.when(~F.col("base_failed"), _distance("centre", "precision"))
    x = x.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= LIMIT))
    return x.select("row", *COUNTS, "base_failed", "distance", kept.alias("kept"))
