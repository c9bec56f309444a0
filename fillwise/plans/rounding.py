"""Output rounding shared by registered queries and their SQL oracles.

Both sides round the double half away from zero on the scaled value,
``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``, which is what DuckDB's
``round(DOUBLE, d)`` computes. Spark's own ``round`` rounds the shortest decimal
form instead, and the two disagree at ties such as 4580979.825.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_half_away(c, d: int):
    p = float(10 ** d)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(p) + F.lit(0.5)).cast("double") / F.lit(p)


def round_spark(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    for c, d in digits.items():
        df = df.withColumn(c, round_half_away(F.col(c).cast("double"), d))
    return df


def round_sql(sql: str, digits: Mapping[str, int]) -> str:
    if not digits:
        return sql
    parts = ", ".join(f"round(CAST({c} AS DOUBLE), {d}) AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({parts}) FROM (\n{sql}\n) AS q"
