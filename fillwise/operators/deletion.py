"""The backtest's rule-based models fitted by subtraction.

Each repeat trains on the pool without its held-out rows. Sums and counts are exact
decimals and integers, so a repeat's train sums are the pool's less those of its held-out
rows, to the last digit; quantiles come from the pool's slices under deletion
(``quantiles_without``); and the naive lag reads the whole pool in every repeat, as score rows
keep their actuals, so it is computed once. The pool is read once per statistic and never
copied: only the held-out rows, which are scored anyway, are there once a repeat.

A level's sums are subtracted only for the keys that a repeat's held-out rows have: no other
is looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, DEFAULT, MONTH, STREAMS, TARGET, Params
from fillwise.functions.joins import attach_scalars, lookup_join
from fillwise.functions.quantiles import quantiles_without
from fillwise.functions.safe import non_negative, safe_div
from fillwise.operators.baselines import apply_epsr, apply_group_average, cohort_sums
from fillwise.operators.nowcast import NowcastFit, apply_nowcast, cap_probs, train_rps
from fillwise.session import cut_lineage

SUMS = ["_rev", "_str", "_known", "_rows"]
LEVELS = {"cohort": COHORT, "territory_dsp": ["territory_name", "dsp"], "dsp": ["dsp"], "global": []}


def train_sums(pool: DataFrame, held: DataFrame, repeat: str) -> dict[str, DataFrame]:
    """Per level, the sums of each repeat's train rows for the keys its held-out rows have."""
    whole, gone = cohort_sums(pool), cut_lineage(cohort_sums(held, [repeat]))
    # the levels stacked, keys above a level blank
    every = [F.struct(F.lit(name).alias("level"), *[(F.col(c) if c in keys else F.lit("")).alias(f"_{c}") for c in COHORT])
             for name, keys in LEVELS.items()]

    def stacked(df: DataFrame, own: list[str], suffix: str) -> DataFrame:
        on = ["level", *[f"_{c}" for c in COHORT]]
        return (df.select(*own, F.explode(F.array(*every)).alias("_l"), *SUMS).select(*own, "_l.*", *SUMS)
                .groupBy(*own, *on).agg(*[F.sum(c).alias(c + suffix) for c in SUMS]))

    both = lookup_join(stacked(gone, [repeat], ""), stacked(whole, [], "_all"), ["level", *[f"_{c}" for c in COHORT]], "inner")
    # a sum over no value is no value, as in a plain aggregate
    left = [F.when(F.col("_known_all") > F.col("_known"), F.col("_rev_all") - F.coalesce("_rev", F.lit(0))).alias("_rev"),
            F.when(F.col("_rows_all") > F.col("_rows"), F.col("_str_all") - F.coalesce("_str", F.lit(0))).alias("_str"),
            (F.col("_known_all") - F.col("_known")).alias("_known"), (F.col("_rows_all") - F.col("_rows")).alias("_rows")]
    sums = cut_lineage(both.select(repeat, "level", *[F.col(f"_{c}").alias(c) for c in COHORT], *left))
    return {name: sums.where(F.col("level") == name).select(repeat, *keys, *SUMS) for name, keys in LEVELS.items()}


def train_quantiles(pool: DataFrame, held: DataFrame, repeat: str, copies: Callable[[DataFrame], DataFrame],
                    params: Params) -> DataFrame:
    """Per repeat, in one pass: median of revenue (``of`` revenue), and the RPS quantiles of each
    DSP (of dsp) and of all (of all)."""
    def values(df: DataFrame, own: list[str]) -> DataFrame:
        rps = train_rps(df).select(*own, F.col("dsp"), F.col("_rps").alias("_v"))
        return (rps.select(*own, F.lit("dsp").alias("of"), "dsp", "_v")
                .unionByName(rps.select(*own, F.lit("all").alias("of"), F.lit("").alias("dsp"), "_v"))
                .unionByName(df.select(*own, F.lit("revenue").alias("of"), F.lit("").alias("dsp"), F.col(TARGET).cast("double").alias("_v"))))

    return cut_lineage(quantiles_without(values(pool, []), values(held, [repeat]), "_v", cap_probs(params), copies, repeat, ["of", "dsp"]))


def held_predictions(pool: DataFrame, held: DataFrame, repeat: str, copies: Callable[[DataFrame], DataFrame],
                     names: tuple[str, str, str, str], params: Params = DEFAULT) -> DataFrame:
    """(model, repeat, grain, actual, pred) of the held-out rows by the four rule-based models,
    ``names`` being the labels of group average, naive, EPSR and nowcast. The rows gather what
    all models learned in one chain of lookups."""
    by = [repeat]
    sums, q = train_sums(pool, held, repeat), train_quantiles(pool, held, repeat, copies, params)
    average, naive, epsr, nowcast = names

    def mean(level: str, out: str) -> DataFrame:
        return sums[level].select(repeat, *LEVELS[level], F.try_divide(F.col("_rev").cast("double"), F.col("_known")).alias(out))

    s = apply_group_average(held, mean("cohort", "_group_avg"), mean("global", "_global_avg"), by, out="_average")
    # the lag over the whole pool, once; only rows without one need their repeat's median
    lag = F.lag(TARGET, 1).over(Window.partitionBy(*COHORT).orderBy(MONTH))
    s = lookup_join(s, pool.select(MONTH, *COHORT, lag.alias("_lag")), [MONTH, *COHORT], "left")
    s = attach_scalars(s, q.where("of = 'revenue'").select(repeat, F.col("_med").alias("_median")), by, bound=None)
    s = s.withColumn("_naive", non_negative(F.coalesce("_lag", "_median"))).drop("_lag", "_median")
    rates = {name: x.select(repeat, *LEVELS[name], safe_div(F.col("_rev").cast("double"), "_str").alias(f"epsr_{name}"))
             for name, x in sums.items()}
    s = apply_epsr(s, rates, by, out="_epsr_pred").drop("epsr_rate_used")
    s = cut_lineage(s.withColumn("_epsr", F.col("_epsr_pred")))
    totals = sums["global"].select(repeat, F.col("_rev").cast("double").alias("_tr"), F.col("_str").alias("_ts"))
    fit = NowcastFit(rates, totals, q.where("of = 'dsp'").drop("of"), q.where("of = 'all'").drop("of", "dsp"))
    s = apply_nowcast(fit, s, params, by, out="_nowcast")
    models = F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("pred"))
                       for name, c in ((average, "_average"), (naive, "_naive"), (epsr, "_epsr"), (nowcast, "_nowcast"))])
    return (s.select(repeat, MONTH, *COHORT, TARGET, F.explode(models).alias("_m"))
            .select("_m.model", repeat, MONTH, *COHORT, TARGET, "_m.pred"))
