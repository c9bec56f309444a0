"""Time columns, cohort lags (W1, W2), jump ratio (W5) and model feature rows (M1).

The lag is the previous ROW of the cohort ordered by month, not the previous
calendar month (cohorts have gaps). One window, partitioned by the cohort: the
shuffle is on the cohort key, and each cohort is one time series (months), so a
window partition is bounded by the number of months, never by the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fillwise.config import COHORT, DEFAULT, MONTH, STREAMS, TARGET, Params
from fillwise.functions.safe import safe_div


def add_time_columns(df: DataFrame) -> DataFrame:
    """month as DATE plus month_str (yyyy-MM), month_num and quarter."""
    m = F.to_date(F.col(MONTH))
    return (df.withColumn(MONTH, m)
            .withColumn("month_str", F.date_format(MONTH, "yyyy-MM"))
            .withColumn("month_num", F.month(MONTH))
            .withColumn("quarter", F.quarter(MONTH)))


def add_lag_features(df: DataFrame, lag: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """gross_lag_k, streams_lag_k and epsr_lag_k = gross_lag / nullif(streams_lag, 0)."""
    w = Window.partitionBy(*by, *COHORT).orderBy(MONTH)
    out = add_time_columns(df)
    out = (out.withColumn(f"gross_lag_{lag}", F.lag(TARGET, lag).over(w))
           .withColumn(f"streams_lag_{lag}", F.lag(STREAMS, lag).over(w)))
    return out.withColumn(f"epsr_lag_{lag}", safe_div(f"gross_lag_{lag}", f"streams_lag_{lag}"))


def jump_ratio(df: DataFrame, value: str = TARGET, params: Params = DEFAULT) -> DataFrame:
    """Value / previous row's value in the cohort; flagged outside [lo, hi]."""
    w = Window.partitionBy(*COHORT).orderBy(MONTH)
    prev = F.lag(value, 1).over(w)
    out = df.withColumn("prev_value", prev).withColumn("jump_ratio", safe_div(value, "prev_value"))
    r = F.col("jump_ratio")
    return out.withColumn("jump_flag", F.when((r < params.jump_lo) | (r > params.jump_hi), 1).otherwise(0))
