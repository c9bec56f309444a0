"""Null-safe arithmetic that keeps pandas' missing-value semantics on Spark.

pandas propagates NaN through ``clip`` and turns x/0 into inf, then cleans it;
Spark's ANSI mode raises on x/0 and ``greatest(NULL, c)`` returns ``c``. These
helpers keep NULL as NULL and never divide by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def clip(x: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip that keeps NULL (pandas ``Series.clip`` keeps NaN)."""
    c = col(x)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def non_negative(x: str | Column) -> Column:
    return clip(x, lo=0.0)


def finite_or_null(x: str | Column) -> Column:
    """NaN and +-inf become NULL (applied at ingestion and after risky maths)."""
    c = col(x).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def per_million(streams: str | Column) -> Column:
    return col(streams).cast("double") / F.lit(1_000_000.0)
