"""Exploration tables: missingness profile (A16), flag counts (A17), monthly
totals (A21), table profile (A22) and category levels (A23).

Each is one aggregation job; the multi-level ones use GROUPING SETS so the input
is scanned once for all levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwise.config import COHORT, FLAG, MONTH, STREAMS, TARGET
from fillwise.functions.money import money_sum
from fillwise.operators.flags import is_target


def missing_profile(panel: DataFrame) -> DataFrame:
    """Per month, rows, missing-or-zero rows and their share."""
    g = (panel.groupBy(F.date_format(MONTH, "yyyy-MM").alias("month_str"))
         .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(is_target()).alias("target_rows")))
    return g.withColumn("target_share", F.col("target_rows") / F.col("total_rows"))


def flag_counts(flagged: DataFrame) -> DataFrame:
    """NA / zero / quality-flag counts by cohort and by each single dimension."""
    df = flagged.withColumn("month_str", F.date_format(MONTH, "yyyy-MM"))
    dims = [*COHORT, "month_str"]
    sets = [list(COHORT), ["business_unit"], ["territory_name"], ["dsp"], ["month_str"]]
    g = df.groupingSets(sets, *dims).agg(
        F.sum("is_na").alias("is_na"), F.sum("is_zero").alias("is_zero"), F.sum(FLAG).alias(FLAG),
        F.grouping_id(*dims).cast("int").alias("level"))
    return g


def monthly_totals(panel: DataFrame, dims: Sequence[str] = ("dsp", "territory_name")) -> DataFrame:
    """Revenue and streams by month and one dimension (NULL groups kept)."""
    dims = list(dims)
    sets = [[MONTH, d] for d in dims]
    g = panel.groupingSets(sets, MONTH, *dims).agg(
        money_sum(TARGET).alias(TARGET), F.sum(STREAMS).alias(STREAMS),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for d in dims:
        name = F.when(F.col(f"_g_{d}") == 0, F.lit(d)).otherwise(name)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return g.select(name.alias("dimension"), value.alias("value"), MONTH, TARGET, STREAMS)


def row_digest(df: DataFrame) -> Column:
    """32 bytes that stand for a whole row: the SHA-256 of its columns' names, nulls and texts."""
    parts = []
    for c in sorted(df.columns):
        text = F.col(f"`{c}`").cast("string")
        # the length before each text keeps neighbouring columns apart; a null has none
        parts += [F.lit(f"{c}="), F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column, the table's rows, the column's NULL count and the table's duplicate rows
    (rows minus distinct rows). One reading: rows are counted by digest, so the shuffle holds 32
    bytes and the null counts of each distinct row, partly summed before it, not whole rows."""
    named = {c: f"_n{i}" for i, c in enumerate(df.columns)}
    nulls = [F.col(f"`{c}`").isNull().cast("int").alias(n) for c, n in named.items()]
    distinct = df.select(row_digest(df).alias("_d"), *nulls).groupBy("_d").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(n).alias(n) for n in named.values()])
    # equal rows have equal nulls, so a distinct row's nulls count as often as the row
    counts = distinct.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("_distinct"),
                          *[F.coalesce(F.sum(F.col(n) * F.col("_rows")), F.lit(0)).alias(n) for n in named.values()])
    one = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(n).alias("nulls")) for c, n in named.items()])
    return counts.select("rows", "_distinct", F.explode(one).alias("_c")).select(
        F.lit(table).alias("table_name"), "_c.column_name", "rows", "_c.nulls",
        (F.col("rows") - F.col("_distinct")).alias("duplicate_rows"))


def category_levels(df: DataFrame, columns: Sequence[str] = COHORT) -> DataFrame:
    """The distinct values of each categorical column (unpivot + distinct)."""
    cols = list(columns)
    long = df.select(*cols).unpivot([], cols, "column_name", "value")
    return long.distinct()
