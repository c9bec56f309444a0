"""Relative prediction intervals.

Calibration error e = |actual - pred| / max(|pred|, 1e-6); q = its (1 - alpha)
quantile per group when the group has at least ``min_rows`` calibration rows,
else the global one, else 0.25. Bounds pred x (1 -/+ q), clipped at 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.config import DEFAULT, TARGET, Params
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.quantiles import grouped_and_global_quantiles
from fillwise.functions.safe import non_negative


def calibration_quantiles(calibration: DataFrame, cal_pred: str, actual: str = TARGET,
                          group_cols: Sequence[str] = ("dsp",), params: Params = DEFAULT,
                          by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(per-group q with row count, global q): the two lookups of the interval rule."""
    by, group_cols = list(by), list(group_cols)
    q = 1.0 - params.alpha
    err = calibration.withColumn(
        "_rel_err", F.abs(F.col(actual) - F.col(cal_pred))
        / F.greatest(F.abs(F.col(cal_pred)), F.lit(params.rel_err_floor)))
    gq, glob = grouped_and_global_quantiles(err, "_rel_err", {"_q": q}, group_cols, by)
    gq = gq.withColumnRenamed("_q", "_group_q")
    glob = glob.withColumnRenamed("_q", "_global_q")
    if not by:
        glob = glob.agg(F.max("_global_q").alias("_global_q"))
    gn = err.groupBy(*by, *group_cols).agg(F.count(F.lit(1)).alias("_group_n"))
    grp = gn.join(gq, [*by, *group_cols], "left")
    return grp, glob


def add_intervals(prediction: DataFrame, calibration: DataFrame, pred: str, cal_pred: str,
                  actual: str = TARGET, group_cols: Sequence[str] = ("dsp",), params: Params = DEFAULT,
                  by: Sequence[str] = (), lower: str = "nowcast_lower_90",
                  upper: str = "nowcast_upper_90") -> DataFrame:
    by, group_cols = list(by), list(group_cols)
    grp, glob = calibration_quantiles(calibration, cal_pred, actual, group_cols, params, by)
    grp = grp.select(*by, *group_cols,
                     F.when(F.col("_group_n") >= params.interval_min_rows, F.col("_group_q")).alias("_group_q"))
    out = lookup_join(prediction, grp, [*by, *group_cols], "left")
    out = attach_scalars(out, glob, by, bound=None if by else 1)
    q = F.coalesce(F.col("_group_q"), F.col("_global_q"), F.lit(params.interval_fallback_q))
    out = (out.withColumn(lower, non_negative(F.col(pred) * (F.lit(1.0) - q)))
           .withColumn(upper, non_negative(F.col(pred) * (F.lit(1.0) + q))))
    return out.drop("_group_q", "_global_q")
