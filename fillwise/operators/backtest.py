"""Distribution-aware backtest (B1), time holdout (B2), promotion gate (B3) and
the metric tables (A11-A15, A19, A20).

All repeats run in ONE job: every known pool row is repeated ``n_repeats`` times
(a row-local explode), each (repeat, month) holds out the rows with the smallest
hash keys, and every model is fitted with ``repeat`` as an extra grouping key.
The reference draws its samples with numpy's generator; here the sample is the
md5 order of (grain, repeat, seed), and the per-month remainder goes to the
largest fractional shares, so the backtest is deterministic and checkable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, DEFAULT, MONTH, TARGET, Params
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.money import money_sum
from fillwise.functions.quantiles import flag_smallest_k, quantile_partial
from fillwise.functions.safe import safe_div
from fillwise.operators.baselines import epsr_predict, group_average, naive_lag
from fillwise.operators.flags import is_target, known_loose
from fillwise.operators.nowcast import lag_hier_nowcast
from fillwise.session import cut_lineage

# Model labels of the reference's stress test.
GROUP_AVERAGE = "Group Average"
NAIVE = "Naive"
EPSR = "EPSR"
LAG_NOWCAST = "Lag-Aware Hierarchical Nowcast"

REPEAT = "repeat"
#: Sample keys are below this (60 bits), and the margin of their thresholds in standard deviations.
KEYS = 1 << 60
MARGIN = 6.0


def excluded_months(work: DataFrame, latest: int = 2) -> DataFrame:
    """The latest ``latest`` months (mostly missing revenue), as month_str rows.

    A top-k over the distinct months: bounded by the number of months.
    """
    return (work.select(F.date_format(MONTH, "yyyy-MM").alias("month_str")).distinct()
            .orderBy(F.col("month_str").desc()).limit(latest))


def eval_frames(work: DataFrame, excluded: DataFrame) -> DataFrame:
    """P10: one pass adding the three masks; the frames are filters over it."""
    ex = excluded.select("month_str", F.lit(True).alias("_excluded"))
    out = lookup_join(work, ex, ["month_str"], "left", bound=1000)
    inc = F.col("_excluded").isNull()
    return (out.withColumn("known_all", known_loose())
            .withColumn("known_eval", known_loose() & inc)
            .withColumn("target_row", is_target())
            .withColumn("target_eval", is_target() & inc)
            .drop("_excluded"))


def month_distribution(pool: DataFrame, target: DataFrame) -> DataFrame:
    """A15 + allocation: each pool month's share of target rows and holdout count.

    Share = (target rows of the month / all target rows) renormalized over months
    that have known rows; holdout = max(1, int(K * T / (K + T))); per month
    floor(share * holdout), the remainder to the largest fractional parts.
    One row per month: every window here spans the months only.
    """
    k_n = pool.agg(F.count(F.lit(1)).alias("_K"))
    t_n = target.agg(F.count(F.lit(1)).alias("_T"))
    months = pool.select(MONTH).distinct()
    tc = target.groupBy(MONTH).agg(F.count(F.lit(1)).alias("target_rows"))
    tc = lookup_join(tc, months, [MONTH], "left_semi")
    tc = tc.crossJoin(k_n).crossJoin(t_n)
    every = Window.partitionBy()
    share0 = F.col("target_rows") / F.col("_T")
    tc = tc.withColumn("_p0", share0).withColumn("share", F.col("_p0") / F.sum("_p0").over(every))
    holdout = F.greatest(F.lit(1), F.floor(F.col("_K") * (F.col("_T").cast("double") / (F.col("_K") + F.col("_T")))))
    tc = tc.withColumn("holdout_size", holdout.cast("bigint"))
    tc = tc.withColumn("_base", F.floor(F.col("share") * F.col("holdout_size")))
    tc = tc.withColumn("_frac", F.col("share") * F.col("holdout_size") - F.col("_base"))
    rem = F.col("holdout_size") - F.sum("_base").over(every)
    order = F.row_number().over(every.orderBy(F.col("_frac").desc(), F.col(MONTH)))
    tc = tc.withColumn("holdout_rows", (F.col("_base") + F.when(order <= rem, 1).otherwise(0)).cast("bigint"))
    return tc.select(MONTH, "target_rows", "share", "holdout_size", "holdout_rows")


def with_repeats(df: DataFrame, n: int) -> DataFrame:
    """Every row once per repeat 1..n (a row-local explode, no join)."""
    return df.withColumn(REPEAT, F.explode(F.sequence(F.lit(1), F.lit(n).cast("int"))))


def sample_key(seed: int) -> F.Column:
    """First 60 bits of md5(month|bu|territory|dsp|repeat|seed) as a BIGINT."""
    txt = F.concat_ws("|", F.col(MONTH).cast("string"), *[F.col(c) for c in COHORT],
                      F.col(REPEAT).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(txt), 1, 15), 16, 10).cast("bigint")


def holdout_flags(pool: DataFrame, plan: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The pool crossed with the repeats, ``held_out`` true on the test rows: per
    (repeat, month) the ``holdout_rows`` rows with the smallest sample key."""
    rows = with_repeats(pool, params.n_repeats).withColumn("_key", sample_key(params.seed))
    k = with_repeats(plan.select(MONTH, F.col("holdout_rows").alias("_k")), params.n_repeats)
    return flag_smallest_k(rows, "_key", k, [REPEAT, MONTH], "held_out").drop("_key")


def held_out_rows(pool: DataFrame, plan: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The held-out rows of every repeat (the ``held_out`` rows of ``holdout_flags``), written,
    without ranking or copying the rest of the pool.

    Sample keys are uniform, so the k smallest of n lie below a threshold of about k / n of
    their range. Rows under a threshold with a margin of ``MARGIN`` standard deviations pass, a row-local test;
    of these only the band between the two thresholds is ranked, whose size is about
    the root of k. A (repeat, month) whose band misses the k-th key takes a margin four times as wide."""
    sizes = plan.select(MONTH, F.col("holdout_rows").cast("double").alias("_k")).join(
        pool.groupBy(MONTH).agg(F.count(F.lit(1)).cast("double").alias("_of")), MONTH).where(F.col("_k") > 0)
    sizes = cut_lineage(sizes)  # one row a month
    months, margin = sizes.count(), MARGIN
    partitions = max(int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    while True:
        spread = F.lit(margin) * F.sqrt(F.col("_k")) + F.lit(margin * margin)
        bounds = sizes.select(MONTH, "_k", "_of", *[
            F.when(F.lit(high) & (F.col("_k") + spread >= F.col("_of")), F.lit(KEYS))
            .otherwise(F.floor(F.least(F.greatest((F.col("_k") + sign * spread) / F.col("_of"), F.lit(0.0)), F.lit(1.0)) * KEYS))
            .cast("bigint").alias(name) for name, sign, high in (("_low", -1, False), ("_high", 1, True))])
        # spread before it is multiplied: a small pool may lie in one file
        rows = lookup_join(pool, bounds, [MONTH], "inner").repartition(partitions)
        near = cut_lineage(with_repeats(rows, params.n_repeats).withColumn("_key", sample_key(params.seed))
                           .where(F.col("_key") <= F.col("_high")))
        groups = near.groupBy(REPEAT, MONTH).agg(F.first("_k").alias("_k"), F.first("_of").alias("_of"), F.count(F.lit(1)).alias("_near"),
                                                 F.count_if(F.col("_key") < F.col("_low")).alias("_sure"))
        groups = cut_lineage(groups)
        want = F.least(F.col("_k"), F.col("_of"))
        seen = groups.agg(F.count(F.lit(1)).alias("all"), F.count_if((F.col("_near") < want) | (F.col("_sure") > want)).alias("missed")).first()
        if not seen["missed"] and seen["all"] == params.n_repeats * months:
            break
        margin *= 4
    own = [c for c in near.columns if c not in ("_low", "_high", "_k", "_of", "_key")]
    sure = near.where(F.col("_key") < F.col("_low")).select(*own)
    band = Window.partitionBy(REPEAT, MONTH).orderBy("_key")
    rest = lookup_join(near.where(F.col("_key") >= F.col("_low")), groups.select(REPEAT, MONTH, "_sure"), [REPEAT, MONTH], "inner")
    rest = rest.withColumn("_at", F.row_number().over(band)).where(F.col("_at") + F.col("_sure") <= want)
    return cut_lineage(sure.unionByName(rest.select(*own)))


def holdout_split(pool: DataFrame, plan: DataFrame, params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(train, test) for all repeats; train = the pool minus the held-out rows."""
    flagged = holdout_flags(pool, plan, params)
    return (flagged.where(~F.col("held_out")).drop("held_out"),
            flagged.where(F.col("held_out")).drop("held_out"))


FitPredict = Callable[[DataFrame, DataFrame, list], DataFrame]


def _models(params: Params) -> dict[str, FitPredict]:
    return {
        GROUP_AVERAGE: lambda tr, te, by: group_average(tr, te, by, out="pred"),
        NAIVE: lambda tr, te, by: naive_lag(tr, te, by, out="pred"),
        EPSR: lambda tr, te, by: epsr_predict(tr, te, by, out="pred"),
        LAG_NOWCAST: lambda tr, te, by: lag_hier_nowcast(tr, te, params, by=by, out="pred")
        .drop("guardrail_applied"),
    }


def backtest_predictions(train: DataFrame, test: DataFrame, params: Params = DEFAULT,
                         models: dict[str, FitPredict] | None = None) -> DataFrame:
    """(model, repeat, grain, actual, pred) for every model, all repeats in one plan."""
    models = models or _models(params)
    keys = [REPEAT, MONTH, *COHORT]
    parts = [fn(train, test, [REPEAT]).select(F.lit(name).alias("model"), *keys, TARGET,
                                              F.col("pred").cast("double").alias("pred"))
             for name, fn in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _metric_aggs():
    """rows, MAE and WMAPE from exact error sums (a mean of 4-decimal money values
    often sits exactly on a rounding tie, where a float sum's order would decide)."""
    err = F.abs(F.col(TARGET) - F.col("pred"))
    return [F.count(F.lit(1)).alias("rows"), (money_sum(err) / F.count(F.lit(1))).alias("mae"),
            safe_div(money_sum(err), money_sum(F.abs(TARGET))).alias("wmape")]


def method_metrics(preds: DataFrame) -> DataFrame:
    """One metric record per method."""
    return preds.groupBy("model").agg(*_metric_aggs())


def overall_metrics(preds: DataFrame) -> DataFrame:
    """A11-A13 per (model, repeat)."""
    return preds.groupBy("model", REPEAT).agg(*_metric_aggs())


def monthly_metrics(preds: DataFrame) -> DataFrame:
    """A14 per (model, repeat, month)."""
    err = F.abs(F.col(TARGET) - F.col("pred"))
    return preds.groupBy("model", REPEAT, MONTH).agg(
        *_metric_aggs(), money_sum(err).alias("abs_error_sum"), money_sum(F.abs(TARGET)).alias("abs_actual_sum"))


def stress_summary(overall: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Mean, sample std, p10, p50, p90 of WMAPE per model. Each group holds
    ``n_repeats`` values, so the built-in percentile is safe here."""
    stats = overall.groupBy("model").agg(F.avg("wmape").alias("mean"), F.stddev_samp("wmape").alias("std"))
    q = quantile_partial(overall, "wmape", {"p10": 0.10, "p50": 0.50, "p90": 0.90}, ["model"])
    return stats.join(q, "model", "left")


def stress_rank(summary: DataFrame, reference: str = EPSR) -> DataFrame:
    """Rank by mean WMAPE and the difference to the reference model."""
    ref = summary.where(F.col("model") == reference).select(F.col("mean").alias("_ref_mean"))
    out = attach_scalars(summary, ref.agg(F.max("_ref_mean").alias("_ref_mean")))
    rank = F.rank().over(Window.partitionBy().orderBy(F.col("mean"), F.col("model")))
    return out.select("model", "mean", "p50", "p90", (F.col("mean") - F.col("_ref_mean")).alias("delta_vs_epsr"),
                      rank.alias("rank"))


def promotion_gate(summary: DataFrame, preds: DataFrame, params: Params = DEFAULT,
                   reference: str = EPSR) -> DataFrame:
    """B3, the four documented conditions: the mean WMAPE beats the reference's; the p90 is
    lower or similar; no month of any repeat fails in the tail (its WMAPE is a number, and the
    worst one is no worse than the reference's worst beyond a tolerance); and the predictions
    reconcile (every repeat's total is a number within the bounds of the actual total).
    The documents leave "similar" and "extreme" open; their sizes are in ``Params``."""
    ref = summary.where(F.col("model") == reference).agg(F.max("mean").alias("_rm"), F.max("p90").alias("_rp90"))
    worst = preds.groupBy("model", REPEAT, MONTH).agg(
        safe_div(money_sum(F.abs(F.col(TARGET) - F.col("pred"))), money_sum(F.abs(TARGET))).alias("_w"),
        F.count_if(F.col("pred").isNull()).alias("_none"))
    worst = worst.groupBy("model").agg(F.max("_w").alias("_worst"), F.sum("_none").alias("_none"))
    ref_worst = worst.where(F.col("model") == reference).agg(F.max("_worst").alias("_rworst"))
    totals = preds.groupBy("model", REPEAT).agg(safe_div(money_sum("pred"), money_sum(TARGET)).alias("_t"))
    totals = totals.groupBy("model").agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"))
    out = attach_scalars(attach_scalars(summary, ref), ref_worst).join(worst, "model").join(totals, "model")
    beats = F.col("mean") < F.col("_rm")
    p90_ok = F.col("p90") <= F.col("_rp90") * (1 + params.gate_p90_tolerance)
    stable = (F.col("_none") == 0) & (F.col("_worst") <= F.col("_rworst") * (1 + params.gate_worst_tolerance))
    coherent = (F.col("_low") >= params.gate_total_lo) & (F.col("_high") <= params.gate_total_hi)
    return out.select("model", beats.alias("beats_mean"), p90_ok.alias("p90_ok"), stable.alias("stable"),
                      coherent.alias("coherent"),
                      (beats & p90_ok & stable & coherent & (F.col("model") != reference)).alias("promote"))


def time_holdout(known_eval: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B2: validation = the latest month; train = earlier months. With fewer than
    two months, an 80/20 split by an md5 bucket of the grain."""
    bounds = known_eval.agg(F.max(MONTH).alias("_last"), F.countDistinct(MONTH).alias("_months"))
    x = attach_scalars(known_eval, bounds)
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(MONTH).cast("string"), *COHORT)), 1, 8), 16, 10
                    ).cast("bigint") % 100
    is_val = F.when(F.col("_months") >= 2, F.col(MONTH) == F.col("_last")).otherwise(bucket < 20)
    x = x.withColumn("_val", is_val)
    train = x.where(~F.col("_val")).drop("_last", "_months", "_val")
    val = x.where(F.col("_val")).drop("_last", "_months", "_val")
    return train, val
