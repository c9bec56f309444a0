"""Baselines: group average (E1), hierarchical EPSR (E2), naive lag-1.

Every fit takes ``by`` keys (e.g. ``repeat``) so one job fits all backtest repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, MONTH, STREAMS, TARGET
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.money import exact, money_mean
from fillwise.functions.quantiles import exact_quantiles
from fillwise.functions.safe import non_negative, safe_div
from fillwise.session import cut_lineage


def _scalars(df: DataFrame, by: Sequence[str], *aggs) -> DataFrame:
    """A global aggregate: one row per ``by`` group (exactly one row without ``by``)."""
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def group_average(train: DataFrame, score: DataFrame, by: Sequence[str] = (),
                  out: str = "pred") -> DataFrame:
    """Cohort mean of revenue, else the global mean."""
    by = list(by)
    cohort = train.groupBy(*by, *COHORT).agg(money_mean(TARGET).alias("_group_avg"))
    glob = _scalars(train, by, money_mean(TARGET).alias("_global_avg"))
    return apply_group_average(score, cohort, glob, by, out)


def apply_group_average(score: DataFrame, cohort: DataFrame, glob: DataFrame, by: Sequence[str] = (),
                        out: str = "pred") -> DataFrame:
    by = list(by)
    s = lookup_join(score, cohort, [*by, *COHORT], "left")
    s = attach_scalars(s, glob, by, bound=None if by else 1)
    return s.withColumn(out, F.coalesce("_group_avg", "_global_avg")).drop("_group_avg", "_global_avg")


def epsr_rates(train: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Ratio of sums at cohort, territory+dsp, dsp and global level.

    ``train`` is read once: the exact cohort sums are written, and the upper levels add
    them up (sums are additive, decimals exact in any order)."""
    by = list(by)
    return rates_of(cut_lineage(cohort_sums(train, by)), by)


def cohort_sums(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact revenue, streams and rows of every cohort: they add up, and subtract."""
    return rows.groupBy(*by, *COHORT).agg(F.sum(exact(TARGET)).alias("_rev"), F.sum(STREAMS).alias("_str"),
                                          F.count(TARGET).alias("_known"), F.count(F.lit(1)).alias("_rows"))


def rates_of(cohort: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The rates of every level from written cohort sums."""
    by = list(by)
    keys = [*by, *COHORT]

    def level(names: list[str], out: str) -> DataFrame:
        sums = [F.sum("_rev").alias("_rev"), F.sum("_str").alias("_str")]
        g = cohort if names == keys else cohort.groupBy(*names).agg(*sums) if names else cohort.agg(*sums)
        return g.select(*names, safe_div(F.col("_rev").cast("double"), "_str").alias(out))

    return {
        "cohort": level(keys, "epsr_cohort"),
        "territory_dsp": level([*by, "territory_name", "dsp"], "epsr_territory_dsp"),
        "dsp": level([*by, "dsp"], "epsr_dsp"),
        "global": level(by, "epsr_global"),
    }


def apply_epsr(score: DataFrame, rates: dict[str, DataFrame], by: Sequence[str] = (),
               out: str = "pred") -> DataFrame:
    """First available rate of cohort, territory+dsp, dsp, global; pred = streams * rate."""
    by = list(by)
    s = lookup_join(score, rates["cohort"], [*by, *COHORT], "left")
    s = lookup_join(s, rates["territory_dsp"], [*by, "territory_name", "dsp"], "left")
    s = lookup_join(s, rates["dsp"], [*by, "dsp"], "left")
    s = attach_scalars(s, rates["global"], by, bound=None if by else 1)
    rate = F.coalesce("epsr_cohort", "epsr_territory_dsp", "epsr_dsp", "epsr_global")
    s = s.withColumn("epsr_rate_used", rate)
    return (s.withColumn(out, F.col(STREAMS) * F.col("epsr_rate_used"))
            .drop("epsr_cohort", "epsr_territory_dsp", "epsr_dsp", "epsr_global"))


def epsr_predict(train: DataFrame, score: DataFrame, by: Sequence[str] = (), out: str = "pred") -> DataFrame:
    return apply_epsr(score, epsr_rates(train, by), by, out).drop("epsr_rate_used")


def naive_lag(train: DataFrame, score: DataFrame, by: Sequence[str] = (), out: str = "pred") -> DataFrame:
    """Previous row's revenue in the cohort over train and score together,
    else the train median, clipped at 0.

    Score rows keep their actuals in the union, so a held-out row's value can be
    the next row's lag; this reproduces the reference's naive score as published.
    """
    by = list(by)
    keys = [*by, MONTH, *COHORT]
    # Train rows are padded to the score schema, so score rows come out whole
    # (no join back on the grain).
    types = dict(score.dtypes)
    pad = [F.col(c) if c in keys or c == TARGET else F.lit(None).cast(types[c]).alias(c)
           for c in score.columns]
    base = (train.select(*pad, F.lit(False).alias("_score"))
            .unionByName(score.select(*score.columns, F.lit(True).alias("_score"))))
    w = Window.partitionBy(*by, *COHORT).orderBy(MONTH)
    lagged = base.withColumn("_lag", F.lag(TARGET, 1).over(w)).where(F.col("_score"))
    med = exact_quantiles(train, TARGET, {"_median": 0.5}, by)
    if not by:
        med = med.agg(F.max("_median").alias("_median"))
    lagged = attach_scalars(lagged, med, by, bound=None if by else 1)
    pred = non_negative(F.coalesce("_lag", "_median"))
    return lagged.select(*score.columns, pred.alias(out))
