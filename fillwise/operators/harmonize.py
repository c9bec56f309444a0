"""Harmonization: labels, territories, aggregation to the grain, full outer join.

Plan: both facts are summed to the grain first (partial aggregation map-side),
the data-driven territory list is a distinct over the summed revenue, and the
full outer join runs on the two aggregates, whose hash partitioning on the grain
already satisfies the join (no extra shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.config import (GRAIN, OTHER_DSP, OTHER_TERRITORY, REFERENCE_DSP_FAMILIES,
                             REFERENCE_TERRITORIES, STREAMS, TARGET)
from fillwise.functions.joins import lookup_join
from fillwise.functions.money import money_sum
from fillwise.functions.safe import finite_or_null


def label_map_frame(spark: SparkSession, families: Mapping[str, Sequence[str]] = REFERENCE_DSP_FAMILIES
                    ) -> DataFrame:
    """Mapping table (raw_dsp, dsp) from a {family: [raw labels]} dict."""
    rows = [(raw, fam) for fam, raws in families.items() for raw in raws]
    return spark.createDataFrame(rows, "raw_dsp string, dsp string")


def canonicalize_dsp(revenue: DataFrame, label_map: DataFrame, raw_col: str = "dsp") -> DataFrame:
    """Raw label -> family by an exact, case-sensitive match; unmapped -> Other.

    The map is the user's, of any length: Spark broadcasts it when its size allows.
    """
    lm = label_map.select(F.col("raw_dsp").alias("_raw"), F.col("dsp").alias("_family"))
    out = lookup_join(revenue.withColumnRenamed(raw_col, "_raw"), lm, ["_raw"], "left")
    return out.withColumn("dsp", F.coalesce(F.col("_family"), F.lit(OTHER_DSP))).drop("_family")


def unmapped_labels(revenue: DataFrame, label_map: DataFrame, raw_col: str = "dsp") -> DataFrame:
    """Raw labels that fell to Other, with the revenue they carry."""
    lm = label_map.select(F.col("raw_dsp").alias(raw_col))
    return (lookup_join(revenue, lm, [raw_col], "left_anti")
            .groupBy(F.col(raw_col).alias("raw_dsp"))
            .agg(money_sum(TARGET).alias(TARGET)))


def revenue_by_grain(revenue_std: DataFrame) -> DataFrame:
    """A1: revenue summed to the grain (NULL stays NULL for an all-NULL group).

    The sum is exact (DECIMAL), so a cell's total does not depend on the order
    its statement lines arrive in.
    """
    return (revenue_std.groupBy(*GRAIN)
            .agg(money_sum(finite_or_null(TARGET)).alias(TARGET)))


def known_territories(revenue_agg: DataFrame) -> DataFrame:
    """A3: distinct territory names present in revenue."""
    return revenue_agg.select("territory_name").where(F.col("territory_name").isNotNull()).distinct()


def territory_static(streams: DataFrame, names: Sequence[str] = REFERENCE_TERRITORIES) -> DataFrame:
    """Country kept if in the fixed list, else All Other Locations."""
    c = F.col("country")
    return streams.withColumn("territory_name",
                              F.when(c.isin(list(names)), c).otherwise(F.lit(OTHER_TERRITORY)))


def territory_dynamic(streams: DataFrame, known: DataFrame) -> DataFrame:
    """Country kept if it occurs as a revenue territory, else All Other Locations.

    An existence join against the distinct names; Spark broadcasts them when their
    size allows and splits a hot country otherwise. A NULL country never matches
    (SQL ``IN`` semantics).
    """
    k = known.select(F.col("territory_name").alias("country"), F.lit(True).alias("_known"))
    out = streams.join(k, "country", "left")
    return (out.withColumn("territory_name",
                           F.when(F.col("_known"), F.col("country")).otherwise(F.lit(OTHER_TERRITORY)))
            .drop("_known"))


def streams_by_grain(streams_std: DataFrame) -> DataFrame:
    """A2: streams summed to the grain."""
    return streams_std.groupBy(*GRAIN).agg(F.sum(F.col(STREAMS).cast("bigint")).alias(STREAMS))


def na_zero_flags(df: DataFrame) -> DataFrame:
    """P5: is_na / is_zero indicators; a NULL revenue is not zero."""
    t = F.col(TARGET)
    return (df.withColumn("is_na", F.when(t.isNull(), 1).otherwise(0))
            .withColumn("is_zero", F.when(t == 0, 1).otherwise(0)))


def harmonize(revenue: DataFrame, streams: DataFrame, label_map: DataFrame,
              territories: str = "dynamic") -> DataFrame:
    """J1 + P4 + P5: the harmonized panel, one row per grain cell."""
    rev_agg = revenue_by_grain(canonicalize_dsp(revenue, label_map))
    if territories == "dynamic":
        streams_std = territory_dynamic(streams, known_territories(rev_agg))
    else:
        streams_std = territory_static(streams)
    str_agg = streams_by_grain(streams_std)
    joined = str_agg.join(rev_agg, on=list(GRAIN), how="full_outer")
    return na_zero_flags(joined.select(*GRAIN, STREAMS, TARGET))


def with_presence(revenue_agg: DataFrame, streams_agg: DataFrame) -> DataFrame:
    """Which side each grain cell came from (both / streams_only / revenue_only)."""
    s = streams_agg.select(*GRAIN, F.lit(True).alias("_s"))
    r = revenue_agg.select(*GRAIN, F.lit(True).alias("_r"))
    j = s.join(r, on=list(GRAIN), how="full_outer")
    side = (F.when(F.col("_s") & F.col("_r"), F.lit("both"))
            .when(F.col("_s"), F.lit("streams_only")).otherwise(F.lit("revenue_only")))
    return j.select(*GRAIN, side.alias("side"))


def join_coverage(revenue: DataFrame, streams: DataFrame, label_map: DataFrame) -> DataFrame:
    rev_agg = revenue_by_grain(canonicalize_dsp(revenue, label_map))
    str_agg = streams_by_grain(territory_dynamic(streams, known_territories(rev_agg)))
    return with_presence(rev_agg, str_agg).groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(panel: DataFrame) -> DataFrame:
    """Grain keys that occur more than once (empty on a healthy panel)."""
    return (panel.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


def dq_checks(revenue: DataFrame, streams: DataFrame, panel: DataFrame, rel_tol: float = 1e-9
              ) -> DataFrame:
    """Null dimensions, revenue total preserved, streams total preserved.

    Revenue totals are exact decimal sums, compared with a small relative
    tolerance in case inputs carry more than six decimals. Three global
    aggregates, each one row, cross-joined.
    """
    nulls = panel.agg(F.count_if(F.col("month").isNull() | F.col("business_unit").isNull()
                                 | F.col("territory_name").isNull() | F.col("dsp").isNull())
                      .alias("null_dimension_rows"))
    src = revenue.agg(money_sum(TARGET).alias("source_revenue")).crossJoin(
        streams.agg(F.sum(F.col(STREAMS).cast("bigint")).alias("source_streams")))
    fin = panel.agg(money_sum(TARGET).alias("final_revenue"),
                    F.sum(STREAMS).alias("final_streams"))
    j = nulls.crossJoin(src).crossJoin(fin)
    rev_ok = F.abs(F.col("source_revenue") - F.col("final_revenue")) <= F.lit(rel_tol) * F.greatest(
        F.abs(F.col("source_revenue")), F.lit(1.0))
    return j.select(
        "null_dimension_rows",
        F.when(F.col("null_dimension_rows") == 0, "PASS").otherwise("FAIL").alias("dimension_check"),
        F.when(rev_ok, "PASS").otherwise("FAIL").alias("revenue_total_check"),
        F.when(F.col("source_streams") == F.col("final_streams"), "PASS").otherwise("FAIL")
        .alias("streams_total_check"),
        "source_streams", "final_streams", "source_revenue", "final_revenue")
