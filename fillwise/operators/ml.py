"""Model rivals of the nowcast (M1-M6, M9) as Spark ML pipelines (KNN, M7, is in
``fillwise.operators.knn``).

Features (M1/M2): the cohort one-hot (business unit, territory, DSP), month
number, quarter, streams, log1p(streams) (trees only) and the three lags, with
lag gaps filled by the TRAIN median (exact, distributed; not ``Imputer``, whose
median is approximate). Encoders are fitted on the train rows only, and levels
first seen at scoring encode as all zeros, so train and score always share one
column layout.

* LinearRegression (M3) and Ridge (M4) on revenue, clipped at 0. sklearn's
  Ridge penalty ``alpha * ||w||^2`` on raw features is Spark's
  ``regParam = alpha * std_pop(y) / n`` with ``standardization=False`` (Spark's
  normal-equation solver scales the label by its standard deviation).
* Two gradient-boosted tree settings (M5, M6) on log1p(revenue), back with
  expm1, clipped at 0: 350 rounds, rate 0.04, 0.8 row and column sampling;
  depth 4 with 6 rows per leaf, and depth 5 with 30 rows per leaf.

Training is distributed (Spark ML aggregates sufficient statistics and tree
splits across partitions); only the fitted model lives on the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.config import COHORT, MONTH, STREAMS, TARGET
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.quantiles import exact_quantiles
from fillwise.functions.safe import non_negative
from fillwise.session import cut_lineage

LAGS = ("gross_lag_1", "streams_lag_1", "epsr_lag_1")

# Model labels. Those of the linear models and KNN are fixed values of the reference's
# registry; the tree models are Spark ML's and are named as what they are.
LINEAR = "LinearRegression"
RIDGE = "Ridge(alpha=10)"
GBT = "SparkGBT"
GBT_WIDE = "SparkGBT(depth=5)"
KNN = "KNN"


def lag_medians(train: DataFrame) -> DataFrame:
    """One row: the train median of each lag column, from ONE rank-selection pass
    over the three stacked columns."""
    stacked = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in LAGS])).alias("_s"))
    stacked = stacked.select("_s._col", "_s._v")
    med = exact_quantiles(stacked, "_v", {"_m": 0.5}, ["_col"])
    return med.agg(*[F.max(F.when(F.col("_col") == c, F.col("_m"))).alias(f"_med_{c}") for c in LAGS])


def feature_rows(df: DataFrame, medians: DataFrame) -> DataFrame:
    """M1 before encoding: calendar, stream and median-filled lag columns."""
    out = attach_scalars(df, medians)
    out = (out.withColumn("month_num", F.month(MONTH)).withColumn("quarter", F.quarter(MONTH))
           .withColumn("log_streams", F.log1p(F.col(STREAMS).cast("double"))))
    for c in LAGS:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")))
    return out.drop(*[f"_med_{c}" for c in LAGS])


def _tree_encoder(numeric: list[str]) -> Pipeline:
    """Full one-hot (pandas ``get_dummies``): every train level gets a column."""
    idx = StringIndexer(inputCols=list(COHORT), outputCols=[f"_{c}_idx" for c in COHORT],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    # dropLast drops the indexer's slot for unseen levels, so a level first seen at scoring
    # encodes as all zeros (the encoder's own handleInvalid='keep' would add one more slot).
    ohe = OneHotEncoder(inputCols=[f"_{c}_idx" for c in COHORT], outputCols=[f"_{c}_ohe" for c in COHORT], dropLast=True)
    asm = VectorAssembler(inputCols=[f"_{c}_ohe" for c in COHORT] + numeric, outputCol="features",
                          handleInvalid="keep")
    return Pipeline(stages=[idx, ohe, asm])


def _encode_linear(tr: DataFrame, sc: DataFrame, numeric: list[str]) -> tuple[DataFrame, DataFrame]:
    """One-hot without the alphabetically first level (pandas ``drop_first``),
    fitted on train: levels are indexed in descending order so the first level
    is the last index, which ``dropLast`` removes; unseen levels are folded onto
    that index, so both encode as all zeros and the design stays full rank."""
    idx = StringIndexer(inputCols=list(COHORT), outputCols=[f"_{c}_raw" for c in COHORT],
                        handleInvalid="keep", stringOrderType="alphabetDesc").fit(tr)
    sizes = [len(labels) for labels in idx.labelsArray]

    def clamp(df):
        out = idx.transform(df)
        for c, n in zip(COHORT, sizes):
            out = out.withColumn(f"_{c}_idx", F.least(F.col(f"_{c}_raw"), F.lit(float(n - 1))))
        return out
    ohe = OneHotEncoder(inputCols=[f"_{c}_idx" for c in COHORT], outputCols=[f"_{c}_ohe" for c in COHORT],
                        dropLast=True)
    asm = VectorAssembler(inputCols=[f"_{c}_ohe" for c in COHORT] + numeric, outputCol="features",
                          handleInvalid="keep")
    ohe_model = ohe.fit(clamp(tr))
    return (asm.transform(ohe_model.transform(clamp(tr))), asm.transform(ohe_model.transform(clamp(sc))))


def _features(train: DataFrame, score: DataFrame) -> tuple[DataFrame, DataFrame]:
    med = lag_medians(train)
    tr = feature_rows(train, med).withColumn(STREAMS, F.col(STREAMS).cast("double"))
    sc = feature_rows(score, med).withColumn(STREAMS, F.col(STREAMS).cast("double"))
    return tr, sc


LINEAR_NUMERIC = ["month_num", "quarter", STREAMS, *LAGS]
TREE_NUMERIC = ["month_num", "quarter", STREAMS, "log_streams", *LAGS]


def fit_predict_linear(train: DataFrame, score: DataFrame, alpha: float | None = None,
                       out: str = "pred") -> DataFrame:
    """M3 (alpha None) / M4 (ridge): revenue on the linear feature set, clipped at 0."""
    tr, sc = _encode_linear(*_features(train, score), LINEAR_NUMERIC)
    reg = 0.0
    if alpha is not None:
        stats = tr.agg(F.stddev_pop(TARGET).alias("sd"), F.count(F.lit(1)).alias("n")).collect()[0]
        reg = alpha * float(stats.sd or 0.0) / max(int(stats.n), 1)
    lr = LinearRegression(featuresCol="features", labelCol=TARGET, predictionCol="_p", solver="normal",
                          regParam=reg, elasticNetParam=0.0, standardization=False)
    model = lr.fit(tr)
    return model.transform(sc).withColumn(out, non_negative("_p")).drop(
        "_p", "features", *[c for c in sc.columns if c.startswith("_")])


#: Train rows of one task of a tree fit.
FIT_ROWS = 1 << 16


def _fit_rows(encoded: DataFrame, label: str) -> DataFrame:
    """Features and label of a tree fit, encoded once and in as many parts as their number needs.

    Every level of every tree is a job over all parts, whose tasks carry the plan back to the
    last written table: the encoders' functions, if the rows are not written first."""
    rows = cut_lineage(encoded.select("features", label))
    parts = -(-rows.count() // FIT_ROWS)
    return rows.repartition(parts) if parts > 1 else rows.coalesce(1)


def fit_predict_gbt(train: DataFrame, score: DataFrame, wide: bool = False, seed: int = 42,
                    out: str = "pred", rounds: int = 350) -> DataFrame:
    """M5 / M6: boosted trees on log1p(revenue), expm1 back, clipped at 0."""
    tr, sc = _features(train, score)
    enc = _tree_encoder(TREE_NUMERIC).fit(tr)
    tr, sc = enc.transform(tr), enc.transform(sc)
    tr = tr.withColumn("_y", F.log1p(F.col(TARGET)))
    gbt = GBTRegressor(featuresCol="features", labelCol="_y", predictionCol="_p", maxIter=rounds, stepSize=0.04,
                       maxDepth=5 if wide else 4, minInstancesPerNode=30 if wide else 6,
                       subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    model = gbt.fit(_fit_rows(tr, "_y"))
    return (model.transform(sc).withColumn(out, non_negative(F.expm1("_p")))
            .drop("_p", "features", *[c for c in sc.columns if c.startswith("_")]))


def registry() -> dict:
    """M9: the model registry, name -> fit_predict(train, score)."""
    from fillwise.operators.knn import fit_predict_knn
    return {
        GBT: lambda tr, sc: fit_predict_gbt(tr, sc, wide=False),
        GBT_WIDE: lambda tr, sc: fit_predict_gbt(tr, sc, wide=True),
        KNN: lambda tr, sc: fit_predict_knn(tr, sc),
        LINEAR: lambda tr, sc: fit_predict_linear(tr, sc, None),
        RIDGE: lambda tr, sc: fit_predict_linear(tr, sc, 10.0),
    }


# ---------------------------------------------------------------------------
# Linear models for many fits at once (one per ``by`` group, e.g. backtest
# repeat): the normal equations of every group come from ONE aggregation; only
# the small (d x d) systems, one per group, are solved on the driver, as Spark
# ML's normal-equation solver does for a single fit.
# ---------------------------------------------------------------------------


def _levels(df: DataFrame) -> dict[str, list[str]]:
    """Sorted levels of each cohort column (a closed, small vocabulary)."""
    rows = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in COHORT]))
                      .alias("l")).select("l.c", "l.v").where(F.col("v").isNotNull()).distinct().collect())
    out: dict[str, list[str]] = {c: [] for c in COHORT}
    for r in rows:
        out[r.c].append(r.v)
    return {c: sorted(v) for c, v in out.items()}


def _lag_medians_by(train: DataFrame, by: list[str]) -> DataFrame:
    stacked = train.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in LAGS])).alias("_s"))
    med = exact_quantiles(stacked.select(*by, "_s._col", "_s._v"), "_v", {"_m": 0.5}, [*by, "_col"])
    return med.groupBy(*by).agg(*[F.max(F.when(F.col("_col") == c, F.col("_m"))).alias(f"_med_{c}")
                                  for c in LAGS])


def _design_columns(levels: dict[str, list[str]]) -> list:
    """Drop-first one-hot columns, then the linear numeric features (no intercept)."""
    cols = []
    for c in COHORT:
        for lv in levels[c][1:]:
            cols.append((F.col(c) == F.lit(lv)).cast("double"))
    for c in LINEAR_NUMERIC:
        cols.append(F.col(c).cast("double"))
    return cols


def fit_predict_linear_by(train: DataFrame, score: DataFrame, by: list[str], alpha: float | None = None,
                          out: str = "pred") -> DataFrame:
    """M3/M4 fitted once per ``by`` group, all groups in one aggregation job.

    OLS is the minimum-norm least-squares solution (as lstsq on the design);
    Ridge penalizes the raw coefficients with an unpenalized intercept (centred
    normal equations), as the reference's Ridge does. Lag gaps take the group's
    train medians; levels absent from a group's train rows get coefficient 0.
    """
    import numpy as np

    by = list(by)
    med = _lag_medians_by(train, by)
    levels = _levels(train)

    def feats(df):
        x = lookup_join(df, med, by, "left")
        x = x.withColumn("month_num", F.month(MONTH)).withColumn("quarter", F.quarter(MONTH))
        for c in LAGS:
            x = x.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")))
        return x.withColumn("_x", F.array(*_design_columns(levels)))

    tr = feats(train).withColumn("_y", F.col(TARGET).cast("double"))
    d = len(_design_columns(levels))
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sy")]
    aggs += [F.sum(F.col("_x")[i]).alias(f"_s{i}") for i in range(d)]
    aggs += [F.sum(F.col("_x")[i] * F.col("_y")).alias(f"_xy{i}") for i in range(d)]
    aggs += [F.sum(F.col("_x")[i] * F.col("_x")[j]).alias(f"_g{i}_{j}") for i in range(d) for j in range(i, d)]
    moments = tr.groupBy(*by).agg(*aggs).collect()          # one row per group: bounded

    coef_rows = []
    for r in moments:
        n = float(r["_n"])
        s = np.array([r[f"_s{i}"] for i in range(d)], dtype=float)
        xy = np.array([r[f"_xy{i}"] for i in range(d)], dtype=float)
        g = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                g[i, j] = g[j, i] = r[f"_g{i}_{j}"]
        mean_x, mean_y = s / n, r["_sy"] / n
        gc = g - n * np.outer(mean_x, mean_x)               # centred Gram: intercept not penalized
        xyc = xy - n * mean_x * mean_y
        if alpha is None:
            w = np.linalg.pinv(gc, rcond=1e-12, hermitian=True) @ xyc
        else:
            w = np.linalg.solve(gc + alpha * np.eye(d), xyc)
        b = mean_y - mean_x @ w
        coef_rows.append(tuple(r[k] for k in by) + (float(b), [float(v) for v in w]))
    schema = ", ".join([f"{k} {dict(train.dtypes)[k]}" for k in by] + ["_b double", "_w array<double>"])
    coefs = train.sparkSession.createDataFrame(coef_rows, schema)
    sc = lookup_join(feats(score), coefs, by, "left")
    dot = F.aggregate(F.zip_with("_x", "_w", lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v)
    res = sc.withColumn(out, non_negative(F.col("_b") + dot))
    return res.drop("_x", "_b", "_w", *[f"_med_{c}" for c in LAGS])
