"""panel -> flags -> lags -> nowcast + intervals -> labelled deliverable -> audits.

Stage boundaries:
* the flagged, lag-featured panel feeds training, scoring, calibration and the
  output, so it is materialized once in the shared checkpoint folder;
* target rows and calibration (train) rows are scored in ONE nowcast pass, each
  set reconciling on its own (``reconcile_by=["_role"]``);
* the deliverable is nowcast rows UNION actual rows: no join back on the grain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.config import (DEFAULT, FLAG, GRAIN, PER_MILLION, REASON_FLAG, REASON_MISSING, REASON_NONE,
                             STATUS_ACTUAL, STATUS_NOWCASTED, STREAMS, TARGET, Params)
from fillwise.operators import audit
from fillwise.operators.features import add_lag_features
from fillwise.operators.flags import add_quality_flags, is_target, to_nowcast, train_mask
from fillwise.operators.intervals import add_intervals
from fillwise.operators.nowcast import lag_hier_nowcast
from fillwise.session import cut_lineage

DELIVERABLE = [*GRAIN, STREAMS, TARGET, "filled_revenue", "nowcast_lower_90", "nowcast_upper_90",
               "value_status", "nowcast_reason", "rps"]
INTERVAL_GROUPS = ("territory_name", "dsp")


def prepare(panel: DataFrame, params: Params = DEFAULT, materialize: bool = True) -> DataFrame:
    """Flag once (Q1) and add lag features."""
    work = add_lag_features(add_quality_flags(panel, params))
    return cut_lineage(work) if materialize else work


def score_and_calibrate(work: DataFrame, params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """N1 on target rows and on train rows (calibration) in one pass."""
    train = work.where(train_mask())
    both = (work.where(to_nowcast()).withColumn("_role", F.lit("score"))
            .unionByName(train.withColumn("_role", F.lit("calib"))))
    # Materialized once: the calibration quantiles and the scored rows both read it.
    pred = cut_lineage(lag_hier_nowcast(train, both, params, reconcile_by=["_role"], keep_parts=True))
    score = pred.where(F.col("_role") == "score").drop("_role")
    calib = pred.where(F.col("_role") == "calib").drop("_role").withColumnRenamed("nowcast_pred", "calibration_pred")
    return score, calib


def scored_with_intervals(work: DataFrame, params: Params = DEFAULT) -> DataFrame:
    score, calib = score_and_calibrate(work, params)
    return add_intervals(score, calib, "nowcast_pred", "calibration_pred", TARGET, INTERVAL_GROUPS, params)


def assemble_final(work: DataFrame, scored: DataFrame) -> DataFrame:
    """The 12-column deliverable (P11-P14): nowcast rows UNION actual rows."""
    reason = (F.when(is_target(), F.lit(REASON_MISSING))
              .when(F.col(FLAG) == 1, F.lit(REASON_FLAG)).otherwise(F.lit(REASON_NONE)))
    nowcasted = scored.select(*GRAIN, STREAMS, TARGET, F.col("nowcast_pred").alias("filled_revenue"),
                              "nowcast_lower_90", "nowcast_upper_90",
                              F.lit(STATUS_NOWCASTED).alias("value_status"), reason.alias("nowcast_reason"))
    actual = work.where(~to_nowcast()).select(
        *GRAIN, STREAMS, TARGET, F.col(TARGET).alias("filled_revenue"),
        F.lit(None).cast("double").alias("nowcast_lower_90"), F.lit(None).cast("double").alias("nowcast_upper_90"),
        F.lit(STATUS_ACTUAL).alias("value_status"), F.lit(REASON_NONE).alias("nowcast_reason"))
    out = nowcasted.unionByName(actual)
    rps = F.when(F.col(STREAMS) > 0, F.col("filled_revenue") / (F.col(STREAMS) / F.lit(PER_MILLION)))
    return out.withColumn("rps", rps).select(*DELIVERABLE)


def final_view(work: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return assemble_final(work, scored_with_intervals(work, params))


@dataclass
class RunOutputs:
    final: DataFrame
    suspicious: DataFrame
    reliability: DataFrame
    summary: DataFrame


def run_nowcast_and_audit(panel: DataFrame, params: Params = DEFAULT, materialize: bool = True) -> RunOutputs:
    """The whole F1 run: deliverable, two audits and the run summary."""
    work = prepare(panel, params, materialize)
    final = final_view(work, params)
    if materialize:
        final = cut_lineage(final)
    suspicious = audit.suspicious_rows(final, params)
    reliability = audit.dsp_month_reliability(final, params)
    return RunOutputs(final, suspicious, reliability, audit.run_summary(final, suspicious, reliability))
