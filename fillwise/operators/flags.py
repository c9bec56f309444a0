"""Row masks (P6-P8) and the fixed-effects low-revenue flag (Q1).

Q1 plan: one GROUPING SETS aggregate over known rows gives the global, territory
and DSP means and counts; the residual threshold is a distributed exact quantile.
The flag does not depend on row order, so it is computed once and reused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwise.config import DEFAULT, FLAG, STREAMS, TARGET, Params
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.quantiles import exact_quantiles
from fillwise.session import cut_lineage


def known_strict() -> Column:
    """Not missing, not zero, streams > 0 and revenue > 0."""
    return ((F.col("is_na") == 0) & (F.col("is_zero") == 0) & (F.col(STREAMS) > 0)
            & (F.col(TARGET) > 0))


def known_loose() -> Column:
    """Not missing, not zero, streams > 0 (negative revenue counts as known)."""
    return (F.col("is_na") == 0) & (F.col("is_zero") == 0) & (F.col(STREAMS) > 0)


def is_target() -> Column:
    """Missing or zero revenue."""
    return (F.col("is_na") == 1) | (F.col("is_zero") == 1)


def train_mask() -> Column:
    """Loose known and not quality-flagged."""
    return known_loose() & (F.col(FLAG) == 0)


def to_nowcast() -> Column:
    """Target or quality-flagged."""
    return is_target() | (F.col(FLAG) == 1)


def fe_stats(known: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A5: (global mean, territory mean/n, dsp mean/n) of ``z`` from one GROUPING SETS job, written once."""
    by = list(by)
    sets = [[*by], [*by, "territory_name"], [*by, "dsp"]]
    g = cut_lineage(known.groupingSets(sets, *by, "territory_name", "dsp")
                    .agg(F.avg("_z").alias("_mean"), F.count(F.lit(1)).alias("_n"),
                         F.grouping("territory_name").alias("_gt"), F.grouping("dsp").alias("_gd")))
    mu = g.where((F.col("_gt") == 1) & (F.col("_gd") == 1)).select(*by, F.col("_mean").alias("_mu"))
    terr = g.where(F.col("_gt") == 0).select(*by, "territory_name", F.col("_mean").alias("_t_mean"),
                                             F.col("_n").alias("_t_n"))
    dsp = g.where(F.col("_gd") == 0).select(*by, "dsp", F.col("_mean").alias("_d_mean"),
                                           F.col("_n").alias("_d_n"))
    return mu, terr, dsp


def add_quality_flags(panel: DataFrame, params: Params = DEFAULT, by: Sequence[str] = (),
                      keep_residual: bool = False) -> DataFrame:
    """Q1: ``quality_flag_low_revenue_high_streams`` (0/1) on every row.

    z = ln(max(revenue/streams, floor)) on strict-known rows; residual = z minus
    (global mean + territory effect + dsp effect), an effect counting only when its
    group has at least ``min_group_rows`` known rows; flagged when the residual is
    at or below the ``fe_threshold_quantile`` of known residuals.
    """
    by = list(by)
    known = known_strict()
    z = F.when(known, F.log(F.greatest(F.col(TARGET) / F.col(STREAMS), F.lit(params.log_floor))))
    work = panel.withColumn("_z", z)
    mu, terr, dsp = fe_stats(work.where(known), by)
    # The global mean is one row per `by` group; territory/dsp stats are left to AQE.
    work = attach_scalars(work, mu, by, bound=None if by else 1)
    work = lookup_join(work, terr, [*by, "territory_name"], "left")
    work = lookup_join(work, dsp, [*by, "dsp"], "left")
    m = params.min_group_rows
    t_eff = F.when(F.coalesce(F.col("_t_n"), F.lit(0)) >= m, F.col("_t_mean") - F.col("_mu")).otherwise(0.0)
    d_eff = F.when(F.coalesce(F.col("_d_n"), F.lit(0)) >= m, F.col("_d_mean") - F.col("_mu")).otherwise(0.0)
    work = work.withColumn("_resid", F.col("_z") - (F.col("_mu") + t_eff + d_eff))
    tau = exact_quantiles(work.where(known), "_resid", {"_tau": params.fe_threshold_quantile}, by)
    if by:
        work = attach_scalars(work, tau, by, bound=None)
    else:
        work = attach_scalars(work, tau.agg(F.max("_tau").alias("_tau")))
    low = F.col("_resid") <= F.coalesce(F.col("_tau"), F.lit(params.tau_fallback))
    if params.low_revenue_threshold is not None:
        low = low & (F.col(TARGET) <= F.lit(params.low_revenue_threshold))
    flag = F.when(known & F.coalesce(low, F.lit(False)), 1).otherwise(0)
    work = work.withColumn(FLAG, flag)
    drop = ["_z", "_mu", "_t_mean", "_t_n", "_d_mean", "_d_n", "_tau"]
    if not keep_residual:
        drop.append("_resid")
    return work.drop(*drop)
