"""Audits of the final view: hard-invalid rows (P15), robust outliers (R2),
(month, dsp) reliability (R1), summaries at any grain (A18), run summary (A25),
DSP growth (A26), roll-up coherence (B4) and the documented-only rules (R3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwise.config import (COHORT, DEFAULT, MONTH, PER_MILLION, REASON_FLAG, REASON_MISSING,
                             STATUS_NOWCASTED, STREAMS, TARGET, Params)
from fillwise.functions.joins import attach_scalars
from fillwise.functions.money import money_sum
from fillwise.functions.quantiles import exact_quantiles, global_quantiles
from fillwise.functions.safe import safe_div


def hard_invalid() -> Column:
    """Filled < 0, or streams <= 0, or RPS missing / not finite (NULL-safe)."""
    rps = F.col("rps")
    return (F.coalesce(F.col("filled_revenue") < 0, F.lit(False))
            | F.coalesce(F.col(STREAMS) <= 0, F.lit(False))
            | rps.isNull() | F.isnan(rps) | (F.abs(rps) == float("inf")))


def robust_z(final: DataFrame, params: Params = DEFAULT, by: Sequence[str] = (),
             value: str = "rps", out: str = "robust_z_all") -> DataFrame:
    """R2: z = 0.6745 (x - median) / MAD of x = log1p(RPS); NULL when MAD is not > 0.

    Two distributed medians chained by a one-row (or per-``by``) join.
    """
    by = list(by)
    x = final.withColumn("_lx", F.log1p(F.col(value)))
    med = exact_quantiles(x, "_lx", {"_med": 0.5}, by)
    if not by:
        med = med.agg(F.max("_med").alias("_med"))
    x = attach_scalars(x, med, by, bound=None if by else 1)
    x = x.withColumn("_absdev", F.abs(F.col("_lx") - F.col("_med")))
    mad = exact_quantiles(x, "_absdev", {"_mad": 0.5}, by)
    if not by:
        mad = mad.agg(F.max("_mad").alias("_mad"))
    x = attach_scalars(x, mad, by, bound=None if by else 1)
    z = F.when(F.col("_mad") > 0, F.lit(params.robust_z_const) * (F.col("_lx") - F.col("_med")) / F.col("_mad"))
    return x.withColumn(out, z).drop("_lx", "_med", "_absdev", "_mad")


def suspicious_rows(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    z = robust_z(final, params)
    return z.where(~hard_invalid() & F.coalesce(F.abs("robust_z_all") > params.robust_z_limit, F.lit(False)))


def dsp_month_reliability(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(month, dsp) sums and a caution flag when the nowcast rate is >= 80% or
    the interval width is >= 35% of the mid estimate. Bounds exist on nowcast
    rows only; empty sums are 0."""
    zero = F.lit(0.0)
    g = (final.groupBy(MONTH, "dsp")
         .agg(F.coalesce(F.sum(STREAMS), F.lit(0)).alias(STREAMS),
              F.coalesce(money_sum("filled_revenue"), zero).alias("revenue_mid"),
              F.coalesce(money_sum("nowcast_lower_90"), zero).alias("revenue_lower"),
              F.coalesce(money_sum("nowcast_upper_90"), zero).alias("revenue_upper"),
              F.count_if(F.col("value_status") == STATUS_NOWCASTED).alias("nowcast_rows"),
              F.count(F.lit(1)).alias("total_rows")))
    g = g.where(F.col(STREAMS) > 0)
    width = F.when(F.col("revenue_mid") > 0,
                   (F.col("revenue_upper") - F.col("revenue_lower")) / F.col("revenue_mid") * 100)
    g = (g.withColumn("rps_mid", F.col("revenue_mid") / (F.col(STREAMS) / F.lit(PER_MILLION)))
         .withColumn("nowcast_rate", F.col("nowcast_rows") / F.col("total_rows"))
         .withColumn("uncertainty_width_pct", width))
    caution = (F.col("nowcast_rate") >= params.caution_rate) | F.coalesce(
        F.col("uncertainty_width_pct") >= params.caution_width_pct, F.lit(False))
    return g.withColumn("risk_flag", F.when(caution, "caution").otherwise("normal"))


def dsp_month_rps_band(final: DataFrame) -> DataFrame:
    """R1, notebook form: bounds of actual rows are the value itself; RPS band."""
    nowc = F.col("value_status") == STATUS_NOWCASTED
    lo = F.when(nowc, F.col("nowcast_lower_90")).otherwise(F.col("filled_revenue"))
    hi = F.when(nowc, F.col("nowcast_upper_90")).otherwise(F.col("filled_revenue"))
    zero = F.lit(0.0)
    g = (final.where(F.col(MONTH).isNotNull() & F.col("dsp").isNotNull())
         .groupBy(MONTH, "dsp")
         .agg(F.coalesce(F.sum(STREAMS), F.lit(0)).alias(STREAMS),
              F.coalesce(money_sum("filled_revenue"), zero).alias("revenue_mid"),
              F.coalesce(money_sum(lo), zero).alias("revenue_lower"),
              F.coalesce(money_sum(hi), zero).alias("revenue_upper"),
              F.count_if(nowc).alias("nowcast_rows"),
              F.count(F.lit(1)).alias("total_rows")))
    per_m = F.col(STREAMS) / F.lit(PER_MILLION)
    return (g.withColumn("rps_mid", safe_div("revenue_mid", per_m))
            .withColumn("rps_lower_90", safe_div("revenue_lower", per_m))
            .withColumn("rps_upper_90", safe_div("revenue_upper", per_m))
            .withColumn("nowcast_rate", F.col("nowcast_rows") / F.col("total_rows"))
            .withColumn("uncertainty_width_pct",
                        safe_div(F.col("revenue_upper") - F.col("revenue_lower"), "revenue_mid") * 100))


def dsp_growth(final: DataFrame) -> DataFrame:
    """first/last month, RPS growth % and latest interval width per DSP
    (min_by / max_by on month: no window, no sort of the whole table)."""
    band = dsp_month_rps_band(final)
    g = band.groupBy("dsp").agg(
        F.min(MONTH).alias("_first"), F.max(MONTH).alias("_last"),
        F.min_by("rps_mid", MONTH).alias("_rps_first"), F.max_by("rps_mid", MONTH).alias("_rps_last"),
        F.max_by("rps_lower_90", MONTH).alias("_lo_last"), F.max_by("rps_upper_90", MONTH).alias("_hi_last"))
    return g.select(
        "dsp",
        F.date_format("_first", "yyyy-MM").alias("first_month"),
        F.date_format("_last", "yyyy-MM").alias("last_month"),
        ((safe_div("_rps_last", "_rps_first") - 1) * 100).alias("rps_growth_pct"),
        (safe_div(F.col("_hi_last") - F.col("_lo_last"), "_rps_last") * 100).alias("latest_uncertainty_width_pct"))


def build_summary(final: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Audit summary at any grain. The reason split is two conditional counts
    in the same aggregate (no pivot, no second shuffle)."""
    group_cols = list(group_cols)
    df = final
    if "month_str" in group_cols and "month_str" not in df.columns:
        df = df.withColumn("month_str", F.date_format(MONTH, "yyyy-MM"))
    nowc = F.col("value_status") == STATUS_NOWCASTED
    g = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(nowc).alias("nowcast_rows"),
        F.count_if(nowc & (F.col("nowcast_reason") == REASON_MISSING)).alias("reason_missing_or_zero"),
        F.count_if(nowc & (F.col("nowcast_reason") == REASON_FLAG)).alias("reason_quality_flag"),
        F.coalesce(F.sum(STREAMS), F.lit(0)).alias(STREAMS),
        money_sum(F.coalesce(F.col(TARGET), F.lit(0.0))).alias("reported_revenue"),
        F.coalesce(money_sum("filled_revenue"), F.lit(0.0)).alias("filled_revenue"))
    return g.select(
        *group_cols, "total_rows",
        (F.col("total_rows") - F.col("nowcast_rows")).alias("actual_rows"),
        "nowcast_rows",
        (F.col("nowcast_rows") / F.col("total_rows") * 100).alias("nowcast_rate_pct"),
        "reason_missing_or_zero", "reason_quality_flag", STREAMS, "reported_revenue", "filled_revenue",
        (F.col("filled_revenue") - F.col("reported_revenue")).alias("revenue_uplift"))


def sort_summary(summary: DataFrame) -> DataFrame:
    """O1: highest nowcast rate first, then most nowcast rows, then most rows
    (a sort of the small summary table, at the sink only)."""
    return summary.orderBy(F.col("nowcast_rate_pct").desc(), F.col("nowcast_rows").desc(),
                           F.col("total_rows").desc())


def run_summary(final: DataFrame, suspicious: DataFrame, reliability: DataFrame) -> DataFrame:
    """The nine counters, as one row (three one-row aggregates cross-joined)."""
    nowc = F.col("value_status") == STATUS_NOWCASTED
    a = final.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(nowc).alias("rows_nowcasted"),
        F.count_if(F.col("nowcast_reason") == REASON_MISSING).alias("rows_nowcasted_missing_or_zero"),
        F.count_if(F.col("nowcast_reason") == REASON_FLAG).alias("rows_nowcasted_quality_flag"),
        F.count_if(~nowc).alias("rows_actual"),
        F.count_if(F.col("nowcast_reason") == REASON_FLAG).alias("quality_flag_rows"),
        F.count_if(hard_invalid()).alias("hard_invalid_rows"))
    b = suspicious.agg(F.count(F.lit(1)).alias("severe_suspicious_rows"))
    c = reliability.agg(F.count_if(F.col("risk_flag") == "caution").alias("dsp_month_caution_rows"))
    return a.crossJoin(b).crossJoin(c)


def rollup_coherence(scored: DataFrame, pred: str = "nowcast_pred") -> DataFrame:
    """Reconciled nowcasts against their EPSR anchors, rolled up over
    (territory, dsp), (territory) and the total; ratio = reconciled / anchor."""
    g = (scored.rollup("territory_name", "dsp")
         .agg(money_sum(pred).alias("reconciled_sum"), money_sum("anchor_pred").alias("anchor_sum"),
              F.count(F.lit(1)).alias("rows"),
              F.grouping_id().cast("int").alias("level")))
    return g.withColumn("ratio", safe_div("reconciled_sum", "anchor_sum"))


# ---------------------------------------------------------------------------
# Documented detection rules that the reference describes but never coded.
# ---------------------------------------------------------------------------

def rule_b_dsp_outliers(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rule B: |robust z| of log1p(RPS) within the DSP > 4.5 (actual and nowcast
    rows audited separately: the z is computed per (value_status, dsp))."""
    valid = final.where(~hard_invalid())
    z = robust_z(valid, params, by=["value_status", "dsp"], out="robust_z_dsp")
    return z.where(F.coalesce(F.abs("robust_z_dsp") > params.rule_b_limit, F.lit(False)))


def rule_d_tails(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rule D: RPS outside its [0.5%, 99.5%] quantiles."""
    valid = final.where(~hard_invalid())
    q = global_quantiles(valid, "rps", {"_lo": params.rule_d_lo, "_hi": params.rule_d_hi})
    x = attach_scalars(valid, q)
    out = x.where((F.col("rps") < F.col("_lo")) | (F.col("rps") > F.col("_hi")))
    return out.withColumn("tail", F.when(F.col("rps") < F.col("_lo"), "low").otherwise("high")).drop("_lo", "_hi")


def tiny_revenue(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Tiny revenue (<= 1) against more than 1M streams."""
    return final.where((F.col("filled_revenue") <= params.tiny_revenue) & (F.col(STREAMS) > params.tiny_streams))


def anomaly_severity(final: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per row: rule B, jump (rule C), rule D and tiny-revenue flags; >= 2 flags
    quarantine, 1 down-weight, 0 normal. Each rule is a column, no self-join."""
    from fillwise.operators.features import jump_ratio

    keys = [MONTH, *COHORT]
    # the jump compares reported revenue with the previous row of the whole cohort
    valid = jump_ratio(final, TARGET, params).where(~hard_invalid())
    z = robust_z(valid, params, by=["value_status", "dsp"], out="robust_z_dsp")
    q = global_quantiles(valid, "rps", {"_lo": params.rule_d_lo, "_hi": params.rule_d_hi})
    z = attach_scalars(z, q)
    flags = z.select(
        *keys,
        F.when(F.coalesce(F.abs("robust_z_dsp") > params.rule_b_limit, F.lit(False)), 1).otherwise(0).alias("rule_b"),
        F.col("jump_flag").alias("rule_c"),
        F.when((F.col("rps") < F.col("_lo")) | (F.col("rps") > F.col("_hi")), 1).otherwise(0).alias("rule_d"),
        F.when((F.col("filled_revenue") <= params.tiny_revenue) & (F.col(STREAMS) > params.tiny_streams), 1)
        .otherwise(0).alias("rule_tiny"))
    n = F.col("rule_b") + F.col("rule_c") + F.col("rule_d") + F.col("rule_tiny")
    sev = F.when(n >= 2, "quarantine").when(n == 1, "down_weight").otherwise("normal")
    return flags.withColumn("n_flags", n).withColumn("severity", sev)
