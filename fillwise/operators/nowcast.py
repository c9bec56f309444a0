"""Lag-aware hierarchical nowcast (N1) and the DSP RPS guardrail (G1).

Plan: the EPSR anchor reads one written table of cohort sums of the train rows; the
lag projection is row-local (lags are already columns); the (month, dsp)
reconciliation is a groupBy whose output (months x families x repeats) is joined
back, never a window, because those few keys would put a third of the rows into
one window partition. The guardrail quantiles are distributed exact quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.config import DEFAULT, MONTH, PER_MILLION, STREAMS, TARGET, Params
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.money import money_sum
from fillwise.functions.quantiles import grouped_and_global_quantiles
from fillwise.functions.safe import clip, non_negative, safe_div
from fillwise.operators.baselines import apply_epsr, epsr_rates


def _safe_streams():
    return F.greatest(F.coalesce(F.col(STREAMS).cast("double"), F.lit(0.0)), F.lit(0.0))


def rps_guardrail(train: DataFrame, scored: DataFrame, pred: str, params: Params = DEFAULT,
                  by: Sequence[str] = ()) -> DataFrame:
    """G1: cap the implied RPS at max(3 x median, 1.25 x p95) of the DSP's train RPS.

    Train rows with streams > 0 and revenue >= 0 give RPS = revenue per 1M streams;
    per DSP the median and p95, the global ones where a DSP has no history. Rows
    without streams get 0. ``guardrail_applied`` marks rows where the cap bit.
    An empty train set leaves the predictions unchanged.
    """
    per_dsp, glob = grouped_and_global_quantiles(train_rps(train), "_rps", cap_probs(params), ["dsp"], by)
    return apply_guardrail(scored, per_dsp, glob, pred, params, by)


def train_rps(train: DataFrame) -> DataFrame:
    """Train rows with streams and revenue, with their RPS."""
    valid = train.where(F.col(STREAMS).isNotNull() & (F.col(STREAMS) > 0)
                        & F.col(TARGET).isNotNull() & (F.col(TARGET) >= 0))
    return valid.withColumn("_rps", F.col(TARGET) / (F.col(STREAMS) / F.lit(PER_MILLION)))


def cap_probs(params: Params) -> dict[str, float]:
    return {"_med": 0.5, "_p95": params.cap_quantile}


def apply_guardrail(scored: DataFrame, per_dsp: DataFrame, glob: DataFrame, pred: str, params: Params = DEFAULT,
                    by: Sequence[str] = ()) -> DataFrame:
    """The caps of G1 from the quantiles of each DSP and of all."""
    by = list(by)
    glob = glob.select(*by, F.col("_med").alias("_gmed"), F.col("_p95").alias("_gp95"))
    if not by:
        glob = glob.agg(F.max("_gmed").alias("_gmed"), F.max("_gp95").alias("_gp95"))
    out = lookup_join(scored, per_dsp, [*by, "dsp"], "left")
    out = attach_scalars(out, glob, by, bound=None if by else 1)
    med = F.coalesce("_med", "_gmed")
    p95 = F.coalesce("_p95", "_gp95")
    cap = F.greatest(F.lit(params.cap_median_mult) * med, F.lit(params.cap_p95_mult) * p95)
    out = out.withColumn("_cap", cap)
    s = _safe_streams()
    p = F.greatest(F.coalesce(F.col(pred), F.lit(0.0)), F.lit(0.0))
    pred_rps = F.when(s > 0, p / (s / F.lit(PER_MILLION)))
    capped = F.when(s > 0, F.least(p, F.col("_cap") * (s / F.lit(PER_MILLION)))).otherwise(F.lit(0.0))
    no_history = F.col("_cap").isNull()
    out = out.withColumn("guardrail_applied",
                         F.when(no_history, F.lit(False)).otherwise(F.coalesce(pred_rps > F.col("_cap"),
                                                                               F.lit(False))))
    out = out.withColumn(pred, F.when(no_history, F.col(pred)).otherwise(non_negative(capped)))
    return out.drop("_med", "_p95", "_gmed", "_gp95", "_cap")


@dataclass
class NowcastFit:
    """What the rule learns of its train rows: EPSR rates by level, revenue and streams in all
    (``_tr``, ``_ts``), and the RPS quantiles of each DSP and of all."""
    rates: dict[str, DataFrame]
    totals: DataFrame
    dsp_rps: DataFrame
    all_rps: DataFrame


def fit_nowcast(train: DataFrame, params: Params = DEFAULT, by: Sequence[str] = ()) -> NowcastFit:
    by = list(by)
    totals = (train.groupBy(*by) if by else train).agg(money_sum(TARGET).alias("_tr"), F.sum(STREAMS).alias("_ts"))
    return NowcastFit(epsr_rates(train, by), totals,
                      *grouped_and_global_quantiles(train_rps(train), "_rps", cap_probs(params), ["dsp"], by))


def lag_hier_nowcast(train: DataFrame, scored: DataFrame, params: Params = DEFAULT,
                     by: Sequence[str] = (), reconcile_by: Sequence[str] = (),
                     out: str = "nowcast_pred", keep_parts: bool = False) -> DataFrame:
    """EPSR anchor, bounded lag trend, (month, dsp) reconciliation, guardrail.

    ``by`` keys split both the fit and the scoring (one model per repeat);
    ``reconcile_by`` keys only split the reconciliation (e.g. scoring target rows
    and calibration rows in one pass while each set reconciles on its own).
    ``scored`` needs the grain, streams, ``gross_lag_1`` and ``streams_lag_1``.
    """
    return apply_nowcast(fit_nowcast(train, params, by), scored, params, by, reconcile_by, out, keep_parts)


def apply_nowcast(fit: NowcastFit, scored: DataFrame, params: Params = DEFAULT, by: Sequence[str] = (),
                  reconcile_by: Sequence[str] = (), out: str = "nowcast_pred", keep_parts: bool = False) -> DataFrame:
    """N1 from a fit. Scored rows that have their EPSR prediction as ``_epsr_pred`` keep it."""
    by = list(by)
    recon_keys = [*by, *reconcile_by, MONTH, "dsp"]
    s = scored
    if "_epsr_pred" not in scored.columns:
        s = apply_epsr(scored, fit.rates, by, out="_epsr_pred").drop("epsr_rate_used")
    tot = fit.totals.select(*by, F.coalesce(F.col("_tr") / F.greatest(F.col("_ts").cast("double"), F.lit(1.0)),
                                     F.lit(0.0)).alias("_gepsr"))
    s = attach_scalars(s, tot, by, bound=None if by else 1)
    ss = _safe_streams()
    # An empty train group has sum 0 in pandas, hence a fallback rate of 0. This
    # fallback is never missing (streams default to 0), so the rule's further
    # fallback to the train median can never apply and is not computed.
    fallback = F.greatest(ss * F.coalesce(F.col("_gepsr"), F.lit(0.0)), F.lit(0.0))
    anchor = non_negative(F.coalesce(F.col("_epsr_pred"), fallback))
    s = s.withColumn("anchor_pred", anchor)

    growth = clip(safe_div(ss, F.col("streams_lag_1").cast("double")), params.growth_lo, params.growth_hi)
    lag_proj = non_negative(F.col("gross_lag_1") * growth)
    s = s.withColumn("lag_proj", lag_proj)
    w = params.lag_weight
    base = F.when(F.col("lag_proj").isNotNull(),
                  F.lit(w) * F.col("lag_proj") + F.lit(1.0 - w) * F.col("anchor_pred")
                  ).otherwise(F.col("anchor_pred"))
    ratio = clip(F.coalesce(safe_div(base, F.col("anchor_pred")), F.lit(1.0)), params.ratio_lo, params.ratio_hi)
    s = s.withColumn("blended_pred", F.col("anchor_pred") * ratio)

    sums = (s.groupBy(*recon_keys)
            .agg(F.sum("blended_pred").alias("_raw_sum"), F.sum("anchor_pred").alias("_anchor_sum")))
    scale = F.when(F.col("_raw_sum") > 0,
                   clip(F.col("_anchor_sum") / F.col("_raw_sum"), params.scale_lo, params.scale_hi)
                   ).otherwise(F.lit(1.0))
    sums = sums.select(*recon_keys, scale.alias("reconcile_scale"))
    s = lookup_join(s, sums, recon_keys, "left")
    s = s.withColumn("reconcile_scale", F.coalesce("reconcile_scale", F.lit(1.0)))
    s = s.withColumn(out, F.coalesce(non_negative(F.col("blended_pred") * F.col("reconcile_scale")),
                                     F.lit(0.0)))
    s = apply_guardrail(s, fit.dsp_rps, fit.all_rps, out, params, by)
    drop = ["_epsr_pred", "_gepsr"]
    if not keep_parts:
        drop += ["anchor_pred", "lag_proj", "blended_pred", "reconcile_scale"]
    return s.drop(*drop)
