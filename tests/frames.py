"""Tiny frames for unit tests: panels built row by row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

PANEL_SCHEMA = ("month date, business_unit string, territory_name string, dsp string, "
                "total_streams bigint, total_gross_amount double, is_na int, is_zero int")


def m(i: int) -> dt.date:
    return dt.date(2025, i, 1)


def panel(spark, rows) -> DataFrame:
    """rows: (month, bu, territory, dsp, streams, revenue); is_na / is_zero derived."""
    out = []
    for month, bu, terr, dsp, streams, rev in rows:
        out.append((month, bu, terr, dsp, streams, rev, 1 if rev is None else 0,
                    1 if rev is not None and rev == 0 else 0))
    return spark.createDataFrame(out, PANEL_SCHEMA)
