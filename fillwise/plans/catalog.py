"""Registered queries: one per operator of the survey's inventory.

Each query takes the shared :class:`Context` and returns a DataFrame; outputs
are rounded (see :mod:`fillwise.plans.rounding`) with the same digits as the
matching oracle under ``oracles/queries/<key>.sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.config import COHORT, FLAG, GRAIN, MONTH, STREAMS, TARGET
from fillwise.functions.money import money_sum
from fillwise.operators import audit, backtest as bt, harmonize as hz, ml, profile as prof
from fillwise.operators.baselines import epsr_predict, epsr_rates, group_average
from fillwise.operators.features import jump_ratio
from fillwise.operators.flags import add_quality_flags, fe_stats, known_strict, to_nowcast, train_mask
from fillwise.operators.intervals import calibration_quantiles
from fillwise.operators.nowcast import lag_hier_nowcast
from fillwise.plans.context import Context, context
from fillwise.plans.rounding import round_spark
from fillwise.functions.tables import replace_by_key
from fillwise.operators.held_models import residuals, revenue_moments
from fillwise.sources.fixtures import source_lines
from fillwise.sources import io as sio


@dataclass
class Query:
    build: Callable[[Context], DataFrame]
    digits: dict[str, int] = field(default_factory=dict)

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_spark(self.build(context(spark, sf_dir)), self.digits)


REGISTRY: dict[str, Query] = {}


def query(key: str, **digits: int):
    def deco(fn):
        REGISTRY[key] = Query(fn, dict(digits))
        return fn
    return deco


M2 = 2     # money
R6 = 6     # ratios, scores, logs

# ---------------------------------------------------------------------------
# Harmonization: scans, label map, territories, grain sums, full outer join
# ---------------------------------------------------------------------------


@query("harmonized_panel", total_gross_amount=M2)
def q_harmonized_panel(ctx: Context) -> DataFrame:
    return ctx.panel()


@query("dsp_canonicalize", total_gross_amount=M2)
def q_dsp_canonicalize(ctx: Context) -> DataFrame:
    """Every raw label with the family it maps to and the revenue it carries."""
    revenue, _, label_map = ctx.facts()
    return (hz.canonicalize_dsp(revenue, label_map)
            .groupBy(F.col("_raw").alias("raw_dsp"), "dsp")
            .agg(money_sum(TARGET).alias(TARGET)))


@query("unmapped_labels", total_gross_amount=M2)
def q_unmapped_labels(ctx: Context) -> DataFrame:
    revenue, _, label_map = ctx.facts()
    return hz.unmapped_labels(revenue, label_map)


@query("revenue_by_grain", total_gross_amount=M2)
def q_revenue_by_grain(ctx: Context) -> DataFrame:
    revenue, _, label_map = ctx.facts()
    return hz.revenue_by_grain(hz.canonicalize_dsp(revenue, label_map))


@query("streams_by_grain")
def q_streams_by_grain(ctx: Context) -> DataFrame:
    revenue, streams, label_map = ctx.facts()
    known = hz.known_territories(hz.revenue_by_grain(hz.canonicalize_dsp(revenue, label_map)))
    return hz.streams_by_grain(hz.territory_dynamic(streams, known))


@query("territory_static")
def q_territory_static(ctx: Context) -> DataFrame:
    _, streams, _ = ctx.facts()
    return (hz.territory_static(streams).groupBy("country", "territory_name")
            .agg(F.sum(STREAMS).alias(STREAMS)))


@query("territory_dynamic")
def q_territory_dynamic(ctx: Context) -> DataFrame:
    revenue, streams, label_map = ctx.facts()
    known = hz.known_territories(hz.revenue_by_grain(hz.canonicalize_dsp(revenue, label_map)))
    return (hz.territory_dynamic(streams, known).groupBy("country", "territory_name")
            .agg(F.sum(STREAMS).alias(STREAMS)))


@query("na_zero_flags")
def q_na_zero_flags(ctx: Context) -> DataFrame:
    return (ctx.panel().groupBy(MONTH)
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("is_na").alias("is_na"),
                 F.sum("is_zero").alias("is_zero")))


@query("join_coverage")
def q_join_coverage(ctx: Context) -> DataFrame:
    return hz.join_coverage(*ctx.facts())


@query("duplicate_keys")
def q_duplicate_keys(ctx: Context) -> DataFrame:
    return hz.duplicate_keys(ctx.panel())


@query("dq_checks", source_revenue=M2, final_revenue=M2)
def q_dq_checks(ctx: Context) -> DataFrame:
    revenue, streams, _ = ctx.facts()
    return hz.dq_checks(revenue, streams, ctx.panel())


# ---------------------------------------------------------------------------
# Flags, masks, time columns, lags
# ---------------------------------------------------------------------------


@query("quality_flags")
def q_quality_flags(ctx: Context) -> DataFrame:
    return add_quality_flags(ctx.panel(), ctx.params).select(*GRAIN, FLAG)


@query("fe_effects", mean_z=R6)
def q_fe_effects(ctx: Context) -> DataFrame:
    p = ctx.panel().where(known_strict())
    p = p.withColumn("_z", F.log(F.greatest(F.col(TARGET) / F.col(STREAMS), F.lit(ctx.params.log_floor))))
    mu, terr, dsp = fe_stats(p)
    return (mu.select(F.lit("global").alias("level"), F.lit(None).cast("string").alias("key"),
                      F.col("_mu").alias("mean_z"), F.lit(None).cast("bigint").alias("n"))
            .unionByName(terr.select(F.lit("territory").alias("level"), F.col("territory_name").alias("key"),
                                     F.col("_t_mean").alias("mean_z"), F.col("_t_n").alias("n")))
            .unionByName(dsp.select(F.lit("dsp").alias("level"), F.col("dsp").alias("key"),
                                    F.col("_d_mean").alias("mean_z"), F.col("_d_n").alias("n"))))


@query("rows_to_nowcast")
def q_rows_to_nowcast(ctx: Context) -> DataFrame:
    w = ctx.work()
    return w.where(to_nowcast()).select(*GRAIN, "is_na", "is_zero", FLAG)


@query("train_rows", total_gross_amount=M2)
def q_train_rows(ctx: Context) -> DataFrame:
    return ctx.work().where(train_mask()).select(*GRAIN, STREAMS, TARGET)


@query("time_columns")
def q_time_columns(ctx: Context) -> DataFrame:
    return ctx.work().select(*GRAIN, "month_str", "month_num", "quarter")


@query("lag_features", gross_lag_1=M2, epsr_lag_1=R6)
def q_lag_features(ctx: Context) -> DataFrame:
    return ctx.work().select(*GRAIN, "gross_lag_1", "streams_lag_1", "epsr_lag_1")


@query("jump_ratio", prev_value=M2, jump_ratio=R6)
def q_jump_ratio(ctx: Context) -> DataFrame:
    return jump_ratio(ctx.panel(), TARGET, ctx.params).select(*GRAIN, "prev_value", "jump_ratio", "jump_flag")


# ---------------------------------------------------------------------------
# Nowcast, guardrail, intervals, final view
# ---------------------------------------------------------------------------


@query("epsr_lookup", rate=R6)
def q_epsr_lookup(ctx: Context) -> DataFrame:
    r = epsr_rates(ctx.work().where(train_mask()))
    null = F.lit(None).cast("string")
    return (r["cohort"].select(F.lit("cohort").alias("level"), *COHORT, F.col("epsr_cohort").alias("rate"))
            .unionByName(r["territory_dsp"].select(F.lit("territory_dsp").alias("level"),
                                                   null.alias("business_unit"), "territory_name", "dsp",
                                                   F.col("epsr_territory_dsp").alias("rate")))
            .unionByName(r["dsp"].select(F.lit("dsp").alias("level"), null.alias("business_unit"),
                                         null.alias("territory_name"), "dsp", F.col("epsr_dsp").alias("rate")))
            .unionByName(r["global"].select(F.lit("global").alias("level"), null.alias("business_unit"),
                                            null.alias("territory_name"), null.alias("dsp"),
                                            F.col("epsr_global").alias("rate"))))


@query("lag_hier_nowcast", anchor_pred=M2, nowcast_pred=M2)
def q_lag_hier_nowcast(ctx: Context) -> DataFrame:
    return ctx.scored().select(*GRAIN, "anchor_pred", "nowcast_pred")


@query("rps_guardrail", nowcast_pred=M2)
def q_rps_guardrail(ctx: Context) -> DataFrame:
    return ctx.scored().select(*GRAIN, "nowcast_pred", "guardrail_applied")


@query("calibration_quantiles", group_q=R6, global_q=R6)
def q_calibration_quantiles(ctx: Context) -> DataFrame:
    from fillwise.plans.final_view import INTERVAL_GROUPS, score_and_calibrate
    _, calib = score_and_calibrate(ctx.work(), ctx.params)
    grp, glob = calibration_quantiles(calib, "calibration_pred", TARGET, INTERVAL_GROUPS, ctx.params)
    return grp.crossJoin(glob).select("territory_name", "dsp", F.col("_group_n").alias("group_n"),
                                      F.col("_group_q").alias("group_q"), F.col("_global_q").alias("global_q"))


@query("prediction_intervals", nowcast_pred=M2, nowcast_lower_90=M2, nowcast_upper_90=M2)
def q_prediction_intervals(ctx: Context) -> DataFrame:
    return ctx.scored().select(*GRAIN, "nowcast_pred", "nowcast_lower_90", "nowcast_upper_90")


FINAL_DIGITS = dict(total_gross_amount=M2, filled_revenue=M2, nowcast_lower_90=M2, nowcast_upper_90=M2, rps=M2)


@query("final_view", **FINAL_DIGITS)
def q_final_view(ctx: Context) -> DataFrame:
    return ctx.final()


@query("status_reason")
def q_status_reason(ctx: Context) -> DataFrame:
    return ctx.final().select(*GRAIN, "value_status", "nowcast_reason")


@query("rps", rps=M2)
def q_rps(ctx: Context) -> DataFrame:
    return ctx.final().select(*GRAIN, "rps")


# ---------------------------------------------------------------------------
# Audits
# ---------------------------------------------------------------------------


@query("hard_invalid", filled_revenue=M2)
def q_hard_invalid(ctx: Context) -> DataFrame:
    return ctx.final().where(audit.hard_invalid()).select(*GRAIN, STREAMS, "filled_revenue")


@query("robust_z", robust_z_all=R6)
def q_robust_z(ctx: Context) -> DataFrame:
    return audit.robust_z(ctx.final(), ctx.params).select(*GRAIN, "robust_z_all")


@query("suspicious_rows", **FINAL_DIGITS, robust_z_all=R6)
def q_suspicious_rows(ctx: Context) -> DataFrame:
    return audit.suspicious_rows(ctx.final(), ctx.params)


RELIABILITY_DIGITS = dict(revenue_mid=M2, revenue_lower=M2, revenue_upper=M2, rps_mid=R6, nowcast_rate=R6,
                          uncertainty_width_pct=R6)


@query("dsp_month_reliability", **RELIABILITY_DIGITS)
def q_dsp_month_reliability(ctx: Context) -> DataFrame:
    return audit.dsp_month_reliability(ctx.final(), ctx.params)


# money per million plays is money: two decimals, as `rps` everywhere
@query("dsp_month_rps_band", **RELIABILITY_DIGITS, rps_lower_90=M2, rps_upper_90=M2)
def q_dsp_month_rps_band(ctx: Context) -> DataFrame:
    return audit.dsp_month_rps_band(ctx.final())


SUMMARY_DIGITS = dict(nowcast_rate_pct=M2, reported_revenue=M2, filled_revenue=M2, revenue_uplift=M2)


def _summary(cols):
    def build(ctx: Context) -> DataFrame:
        out = audit.build_summary(ctx.final(), cols)
        return out.orderBy("month_str") if cols == ["month_str"] else audit.sort_summary(out)
    return build


for _key, _cols in (("nowcast_summary_bu", ["business_unit"]), ("nowcast_summary_dsp", ["dsp"]),
                    ("nowcast_summary_month", ["month_str"]),
                    ("nowcast_summary_territory", ["territory_name"])):
    REGISTRY[_key] = Query(_summary(_cols), dict(SUMMARY_DIGITS))


@query("run_summary")
def q_run_summary(ctx: Context) -> DataFrame:
    final = ctx.final()
    return audit.run_summary(final, audit.suspicious_rows(final, ctx.params),
                             audit.dsp_month_reliability(final, ctx.params))


@query("dsp_growth", rps_growth_pct=R6, latest_uncertainty_width_pct=R6)
def q_dsp_growth(ctx: Context) -> DataFrame:
    return audit.dsp_growth(ctx.final())


@query("nowcast_top5", total_gross_amount=M2, filled_revenue=M2, nowcast_lower_90=M2, nowcast_upper_90=M2,
       rps=M2)
def q_nowcast_top5(ctx: Context) -> DataFrame:
    """O3: first five nowcast rows by month (ties broken by the cohort, so the
    head is deterministic)."""
    f = ctx.final().where(F.col("value_status") == "nowcasted")
    return f.orderBy(MONTH, *COHORT).limit(5)


# ---------------------------------------------------------------------------
# Backtest: all repeats in one job
# ---------------------------------------------------------------------------


@query("eval_frames")
def q_eval_frames(ctx: Context) -> DataFrame:
    """Per month, rows and the three frame sizes."""
    ew = ctx.eval_work()
    return ew.groupBy("month_str").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("known_all").alias("known_all"),
        F.count_if("known_eval").alias("known_eval"), F.count_if("target_row").alias("target_rows"))


@query("month_distribution", share=R6)
def q_month_distribution(ctx: Context) -> DataFrame:
    return ctx.holdout_plan()


@query("backtest_holdout")
def q_backtest_holdout(ctx: Context) -> DataFrame:
    return ctx.held().select(bt.REPEAT, *GRAIN)


@query("backtest_overall", mae=M2, wmape=R6)
def q_backtest_overall(ctx: Context) -> DataFrame:
    return bt.overall_metrics(ctx.predictions())


@query("backtest_monthly", mae=M2, wmape=R6, abs_error_sum=M2, abs_actual_sum=M2)
def q_backtest_monthly(ctx: Context) -> DataFrame:
    return bt.monthly_metrics(ctx.predictions())


def _summary_table(ctx: Context) -> DataFrame:
    return bt.stress_summary(bt.overall_metrics(ctx.predictions()), ctx.params)


@query("stress_summary", mean=R6, std=R6, p10=R6, p50=R6, p90=R6)
def q_stress_summary(ctx: Context) -> DataFrame:
    return _summary_table(ctx)


@query("stress_rank", mean=R6, p50=R6, p90=R6, delta_vs_epsr=R6)
def q_stress_rank(ctx: Context) -> DataFrame:
    return bt.stress_rank(_summary_table(ctx))


@query("stress_summary_all", mean=R6, std=R6, p10=R6, p50=R6, p90=R6)
def q_stress_summary_all(ctx: Context) -> DataFrame:
    """A19 over seven models: the four rule-based ones, LinearRegression and Ridge from train
    matrices by subtraction, and KNN from one placing of the pool."""
    preds = ctx.predictions().unionByName(ctx.predictions_linear()).unionByName(ctx.predictions_knn())
    return bt.stress_summary(bt.overall_metrics(preds), ctx.params)


@query("promotion_gate")
def q_promotion_gate(ctx: Context) -> DataFrame:
    return bt.promotion_gate(_summary_table(ctx), ctx.predictions(), ctx.params)


# ---------------------------------------------------------------------------
# Exploration tables
# ---------------------------------------------------------------------------


@query("missing_profile", target_share=R6)
def q_missing_profile(ctx: Context) -> DataFrame:
    return prof.missing_profile(ctx.panel())


@query("flag_counts")
def q_flag_counts(ctx: Context) -> DataFrame:
    return prof.flag_counts(ctx.work())


@query("monthly_totals", total_gross_amount=M2)
def q_monthly_totals(ctx: Context) -> DataFrame:
    return prof.monthly_totals(ctx.panel())


@query("table_profile")
def q_table_profile(ctx: Context) -> DataFrame:
    return prof.table_profile(ctx.panel(), "panel").unionByName(prof.table_profile(ctx.final(), "final_view"))


@query("source_profile")
def q_source_profile(ctx: Context) -> DataFrame:
    """A22 of the two source tables at line level."""
    revenue, streams = source_lines(ctx.spark, ctx.sf_dir)
    return prof.table_profile(revenue, "revenue").unionByName(prof.table_profile(streams, "streams"))


@query("source_levels")
def q_source_levels(ctx: Context) -> DataFrame:
    """A23 of the two fact tables as they arrive."""
    rev = prof.category_levels(ctx.facts()[0], ["business_unit", "territory_name", "dsp"])
    plays = prof.category_levels(ctx.facts()[1], ["business_unit", "country", "dsp"])
    return rev.withColumn("table_name", F.lit("revenue")).unionByName(plays.withColumn("table_name", F.lit("streams")))


@query("category_levels")
def q_category_levels(ctx: Context) -> DataFrame:
    return prof.category_levels(ctx.panel())


# ---------------------------------------------------------------------------
# Documented detection rules and roll-up coherence
# ---------------------------------------------------------------------------


@query("rule_b_dsp_outliers", robust_z_dsp=R6, **FINAL_DIGITS)
def q_rule_b(ctx: Context) -> DataFrame:
    return audit.rule_b_dsp_outliers(ctx.final(), ctx.params)


@query("rule_d_tails", **FINAL_DIGITS)
def q_rule_d(ctx: Context) -> DataFrame:
    return audit.rule_d_tails(ctx.final(), ctx.params)


@query("tiny_revenue", **FINAL_DIGITS)
def q_tiny_revenue(ctx: Context) -> DataFrame:
    return audit.tiny_revenue(ctx.final(), ctx.params)


@query("anomaly_severity")
def q_anomaly_severity(ctx: Context) -> DataFrame:
    return audit.anomaly_severity(ctx.final(), ctx.params)


@query("rollup_coherence", reconciled_sum=M2, anchor_sum=M2, ratio=R6)
def q_rollup_coherence(ctx: Context) -> DataFrame:
    return audit.rollup_coherence(ctx.scored())


# ---------------------------------------------------------------------------
# In-sample baselines of the notebook, their metrics and the time holdout
# ---------------------------------------------------------------------------


def _known(ctx: Context):
    ew = ctx.eval_work()
    return ew.where(F.col("known_all")), ew.where(F.col("known_eval"))


@query("group_avg_baseline", pred=M2)
def q_group_avg_baseline(ctx: Context) -> DataFrame:
    known_all, known_eval = _known(ctx)
    return group_average(known_all, known_eval).select(*GRAIN, "pred")


@query("epsr_predict", pred=M2)
def q_epsr_predict(ctx: Context) -> DataFrame:
    known_all, known_eval = _known(ctx)
    return epsr_predict(known_all, known_eval).select(*GRAIN, "pred")


def _naive_notebook(ctx: Context) -> DataFrame:
    """E3, notebook form: previous row's revenue over the whole panel, scored on
    known evaluation rows that have one (no fallback)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*COHORT).orderBy(MONTH)
    ew = ctx.eval_work().withColumn("pred", F.lag(TARGET, 1).over(w))
    return ew.where(F.col("known_eval") & F.col("pred").isNotNull())


@query("naive_baseline", pred=M2)
def q_naive_baseline(ctx: Context) -> DataFrame:
    return _naive_notebook(ctx).select(*GRAIN, "pred")


@query("eval_metrics", mae=M2, wmape=R6)
def q_eval_metrics(ctx: Context) -> DataFrame:
    known_all, known_eval = _known(ctx)
    preds = (group_average(known_all, known_eval).select(F.lit("Group Average Baseline").alias("model"),
                                                         TARGET, "pred")
             .unionByName(_naive_notebook(ctx).select(F.lit("Naive Baseline").alias("model"), TARGET, "pred"))
             .unionByName(epsr_predict(known_all, known_eval).select(F.lit("EPSR").alias("model"), TARGET,
                                                                     "pred")))
    return bt.method_metrics(preds)


@query("time_holdout")
def q_time_holdout(ctx: Context) -> DataFrame:
    _, known_eval = _known(ctx)
    train, val = bt.time_holdout(known_eval)
    return (train.agg(F.lit("train").alias("split"), F.count(F.lit(1)).alias("rows"),
                      F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"))
            .unionByName(val.agg(F.lit("validation").alias("split"), F.count(F.lit(1)).alias("rows"),
                                 F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"))))


@query("nowcast_holdout_metrics", mae=M2, wmape=R6)
def q_nowcast_holdout_metrics(ctx: Context) -> DataFrame:
    """The notebook's quick rerun: N1 fitted before the latest month, scored on it."""
    _, known_eval = _known(ctx)
    train, val = bt.time_holdout(known_eval)
    pred = lag_hier_nowcast(train, val, ctx.params, out="pred")
    return bt.method_metrics(pred.select(F.lit(bt.LAG_NOWCAST).alias("model"), TARGET, "pred"))


# ---------------------------------------------------------------------------
# Model rivals (Spark ML): feature rows are SQL-checked, fits are rows-only
# ---------------------------------------------------------------------------


def _holdout(ctx: Context):
    _, known_eval = _known(ctx)
    return bt.time_holdout(known_eval)


@query("feature_rows", gross_lag_1=M2, epsr_lag_1=R6, streams_lag_1=M2, log_streams=R6)
def q_feature_rows(ctx: Context) -> DataFrame:
    """M1 before encoding: validation rows with train-median-filled lags."""
    train, val = _holdout(ctx)
    f = ml.feature_rows(val, ml.lag_medians(train))
    return f.select(*GRAIN, "month_num", "quarter", STREAMS, "log_streams", *ml.LAGS)


def _model_targets(ctx: Context):
    """The notebook's write-back: fit on known evaluation rows, score target and
    flagged rows."""
    from fillwise.operators.flags import to_nowcast
    _, known_eval = _known(ctx)
    return known_eval, ctx.work().where(to_nowcast())


def _model_query(name: str):
    def build(ctx: Context) -> DataFrame:
        train, score = _model_targets(ctx)
        return ml.registry()[name](train, score).select(*GRAIN, "pred")
    return build


for _key, _name in (("gbt_nowcast", ml.GBT), ("gbt_wide_nowcast", ml.GBT_WIDE),
                    ("linear_nowcast", ml.LINEAR), ("ridge_nowcast", ml.RIDGE), ("knn_nowcast", ml.KNN)):
    REGISTRY[_key] = Query(_model_query(_name), {"pred": M2})


@query("model_sweep", mae=M2, wmape=R6)
def q_model_sweep(ctx: Context) -> DataFrame:
    """M9: every registry model on the latest-month holdout, one metric row each."""
    from concurrent.futures import ThreadPoolExecutor

    from fillwise.session import cut_lineage
    train, val = _holdout(ctx)

    def fit(item):
        name, fn = item
        # each fit is materialized by its own Spark jobs; the fits run concurrently
        # (an iterative tree fit leaves most cores idle)
        return cut_lineage(fn(train, val).select(F.lit(name).alias("model"), TARGET, "pred"))
    with ThreadPoolExecutor(max_workers=5) as pool:
        parts = list(pool.map(fit, ml.registry().items()))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    return bt.method_metrics(preds)


@query("linear_residuals", residual=R6)
def q_linear_residuals(ctx: Context) -> DataFrame:
    """M3/M4: the normal equations of both fits on the rows that the write-back trains on, in parts
    of their own sizes: 0 everywhere."""
    train, _ = _model_targets(ctx)
    return residuals(train, {ml.LINEAR: None, ml.RIDGE: 10.0})


@query("linear_moments", mean_product=M2)
def q_linear_moments(ctx: Context) -> DataFrame:
    """M2-M4: products of the design's columns with revenue, per train row, as the fits gather them."""
    train, _ = _model_targets(ctx)
    return revenue_moments(train)


# ---------------------------------------------------------------------------
# Sources and sinks: round trips through files in the shared checkpoint folder
# ---------------------------------------------------------------------------


def _scratch(ctx: Context, name: str) -> str:
    import os
    import uuid

    from fillwise.session import checkpoint_dir
    return os.path.join(checkpoint_dir(ctx.spark), "fillwise-io", f"{name}-{uuid.uuid4().hex}")


@query("scan_csv_roundtrip", total_gross_amount=M2)
def q_scan_csv_roundtrip(ctx: Context) -> DataFrame:
    """Both facts written as header CSV, read back with declared schemas and
    harmonized: the panel must come out unchanged."""
    revenue, streams, label_map = ctx.facts()
    rp, sp = _scratch(ctx, "revenue-csv"), _scratch(ctx, "streams-csv")
    sio.write_csv(revenue, rp)
    sio.write_csv(streams, sp)
    return hz.harmonize(sio.read_revenue_csv(ctx.spark, rp), sio.read_streams_csv(ctx.spark, sp), label_map)


@query("panel_roundtrip", total_gross_amount=M2)
def q_panel_roundtrip(ctx: Context) -> DataFrame:
    """S2 + S4: the panel written as month-partitioned parquet and read back."""
    path = _scratch(ctx, "panel")
    sio.write_panel(ctx.panel(), path)
    return sio.read_panel(ctx.spark, path)


@query("outputs_roundtrip", total_gross_amount=M2, filled_revenue=M2, nowcast_lower_90=M2, nowcast_upper_90=M2, rps=M2)
def q_outputs_roundtrip(ctx: Context) -> DataFrame:
    """The deliverable written with its audits and read back."""
    path = _scratch(ctx, "outputs")
    final = ctx.final()
    sio.write_outputs(final, audit.suspicious_rows(final, ctx.params), audit.dsp_month_reliability(final, ctx.params),
                      q_run_summary(ctx), path)
    back = ctx.spark.read.parquet(f"{path}/final_view")
    return back.withColumn(MONTH, F.col(MONTH).cast("date")).select(*final.columns)


@query("summary_json_roundtrip", **REGISTRY["run_summary"].digits)
def q_summary_json_roundtrip(ctx: Context) -> DataFrame:
    """The run summary written as JSON and read back with its own schema."""
    path = _scratch(ctx, "summary")
    summary = q_run_summary(ctx)
    sio.write_summary(summary, path)
    return ctx.spark.read.schema(summary.schema).json(path)


@query("panel_refresh", total_gross_amount=M2)
def q_panel_refresh(ctx: Context) -> DataFrame:
    """A panel saved before its latest month's revenue arrived, then refreshed with the whole one."""
    path = _scratch(ctx, "refresh")
    panel = ctx.panel()
    last = panel.agg(F.max(MONTH).alias("_last"))
    early = panel.crossJoin(F.broadcast(last)).withColumn(
        TARGET, F.when(F.col(MONTH) < F.col("_last"), F.col(TARGET))).drop("_last")
    sio.write_panel(early, path)
    sio.refresh_panel(panel, path)
    return sio.read_panel(ctx.spark, path)


@query("replace_by_key", mae=M2, wmape=R6)
def q_replace_by_key(ctx: Context) -> DataFrame:
    """The metric table of the rule-based models, the record of EPSR blanked and then put back."""
    table = q_eval_metrics(ctx)
    blank = table.withColumn("wmape", F.when(F.col("model") != "EPSR", F.col("wmape")))
    return replace_by_key(blank, table.where(F.col("model") == "EPSR"), ["model"])


@query("harmonized_panel_sql", total_gross_amount=M2)
def q_harmonized_panel_sql(ctx: Context) -> DataFrame:
    """S3: the same panel from Spark SQL over registered temp views."""
    from fillwise.plans.sql_harmonize import harmonize_sql
    revenue, streams, label_map = ctx.facts()
    return harmonize_sql(ctx.spark, revenue, streams, label_map)


@query("prediction_intervals_sparse", nowcast_pred=M2, nowcast_lower_90=M2, nowcast_upper_90=M2)
def q_prediction_intervals_sparse(ctx: Context) -> DataFrame:
    """I1 with a 200-row minimum per (territory, dsp): most groups fall back to
    the global quantile, so the fallback is exercised at small scale."""
    from dataclasses import replace

    from fillwise.plans.final_view import scored_with_intervals
    params = replace(ctx.params, interval_min_rows=200)
    return scored_with_intervals(ctx.work(), params).select(*GRAIN, "nowcast_pred", "nowcast_lower_90",
                                                            "nowcast_upper_90")
