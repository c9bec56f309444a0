"""The reference's two fact tables, derived from the driver's sales tables.

Sales lines stand in for both facts (FIXTURES.md §3): ``revenue`` carries raw
labels (``Brand#n``) at (month, business unit, territory); ``streams`` carries
play counts at (month, business unit, country, DSP family). An integer ``cell``
of the grain plants zero, missing, under-reported and revenue-only cells.

Plan shape: the order-level attributes (month, segment, country) are joined on
``orders`` before ``lineitem`` is touched, the brand comes from ``part``, and both
facts come out of ONE aggregation at the finest shared grain, so the big join
runs once and everything after it works on grain-sized data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.config import OTHER_DSP, OTHER_TERRITORY
from fillwise.functions.money import money_sum
from fillwise.session import cut_lineage
from fillwise.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fixture rule (FIXTURES.md §3).
# ---------------------------------------------------------------------------
# Brand number ranges and their family: 1-8 FamA, 9-13 FamB, 14-17 FamC,
# 18 FamD, 19 FamE; 20-25 are unmapped and fall to Other.
FAMILY_RANGES = [(1, 8, "FamA"), (9, 13, "FamB"), (14, 17, "FamC"), (18, 18, "FamD"), (19, 19, "FamE")]
NAMED_TERRITORY_KEYS = 9          # nation keys 0..8 keep their name in revenue
LAST_FULL_MONTH_INDEX = 2001 * 12 + 7   # from this month on most revenue is late


def fixture_label_map(spark: SparkSession) -> DataFrame:
    """The raw-label to family table for the fixture (19 rows, built from the ranges)."""
    rows = [(f"Brand#{n}", fam) for lo, hi, fam in FAMILY_RANGES for n in range(lo, hi + 1)]
    return spark.createDataFrame(rows, "raw_dsp string, dsp string")


def _family_number(brand_no: Column) -> Column:
    out = F.lit(len(FAMILY_RANGES) + 1)
    for i, (lo, hi, _fam) in reversed(list(enumerate(FAMILY_RANGES, start=1))):
        out = F.when(brand_no <= hi, F.lit(i)).otherwise(out)
    return out


def _family_name(fam_no: Column) -> Column:
    out = F.lit(OTHER_DSP)
    for i, (_lo, _hi, fam) in enumerate(FAMILY_RANGES, start=1):
        out = F.when(fam_no == i, F.lit(fam)).otherwise(out)
    return out


def _measures() -> tuple[Column, Column, Column, Column]:
    """Which facts a sales line is in, and its revenue and plays."""
    rev_kept = (F.col("cell") % 11 != 0) & ~((F.col("mi") >= LAST_FULL_MONTH_INDEX) & (F.col("cell") % 5 != 0))
    streams_kept = F.col("cell") % 97 != 0
    # prices and discounts have two decimals, so a line has four; rounding leaves no float noise
    amount = F.round(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")), 4)
    reported = (F.when(F.col("cell") % 23 == 0, F.lit(0.0))
                .when(F.col("cell") % 29 == 0, F.round(amount * F.lit(0.01), 6))
                .otherwise(amount))
    plays = (F.col("l_quantity") * 1000).cast("bigint")
    return rev_kept, streams_kept, reported, plays


def _sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with month, segment, country, brand, family number and cell."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    lineitem = read_table(spark, sf_dir, "lineitem",
                          ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"])

    # nation is the fixed 25-row dimension: a proven bound, so broadcast it.
    order_attrs = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                   .join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
                   .select(F.col("o_orderkey").alias("l_orderkey"),
                           F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
                           (F.year("o_orderdate").cast("bigint") * 12 + F.month("o_orderdate")).alias("mi"),
                           F.col("c_mktsegment").alias("business_unit"),
                           F.col("n_name").alias("country"),
                           F.when(F.col("n_nationkey") < NAMED_TERRITORY_KEYS, F.col("n_nationkey"))
                           .otherwise(F.lit(NAMED_TERRITORY_KEYS)).alias("terr_no")))
    brands = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("raw_dsp"))
    lines = lineitem.join(brands, "l_partkey").join(order_attrs, "l_orderkey")

    fam_no = _family_number(F.substring("raw_dsp", 7, 10).cast("int"))
    cell = (F.col("mi") * 7 + F.col("terr_no") * 3 + F.length("business_unit") * 17 + F.col("fam_no") * 5)
    return lines.withColumn("fam_no", fam_no).withColumn("cell", cell)


def sales_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines summed to (month, segment, country, brand), both measures at once."""
    lines = _sales_lines(spark, sf_dir)
    rev_kept, streams_kept, reported, plays = _measures()
    return (lines.groupBy("month", "business_unit", "country", "terr_no", "raw_dsp", "fam_no")
            .agg(money_sum(F.when(rev_kept, reported)).alias("reported"),
                 F.max(rev_kept.cast("int")).alias("rev_kept"),
                 F.sum(F.when(streams_kept, plays)).alias("plays"),
                 F.max(streams_kept.cast("int")).alias("streams_kept")))


def _territory() -> Column:
    return F.when(F.col("terr_no") < NAMED_TERRITORY_KEYS, F.col("country")).otherwise(F.lit(OTHER_TERRITORY))


def source_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(revenue, streams) before any summing: one row a sales line."""
    lines = _sales_lines(spark, sf_dir)
    rev_kept, streams_kept, reported, plays = _measures()
    revenue = lines.where(rev_kept).select("month", "business_unit", _territory().alias("territory_name"),
                                           F.col("raw_dsp").alias("dsp"), reported.alias("total_gross_amount"))
    streams = lines.where(streams_kept).select("month", "business_unit", "country",
                                               _family_name(F.col("fam_no")).alias("dsp"), plays.alias("total_streams"))
    return revenue, streams


def revenue_streams(spark: SparkSession, sf_dir: str, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(revenue, streams) in the reference's input schemas.

    Both facts read one materialized table of sales cells: column pruning gives
    the two branches different lineitem scans, so without it the big join would
    run once per branch (exchange reuse needs identical subtrees).
    """
    cells = sales_cells(spark, sf_dir)
    if materialize:
        cells = cut_lineage(cells)
    revenue = cells.where(F.col("rev_kept") == 1).select(
        "month", "business_unit",
        _territory().alias("territory_name"),
        F.col("raw_dsp").alias("dsp"),
        F.col("reported").alias("total_gross_amount"))
    streams = cells.where(F.col("streams_kept") == 1).select(
        "month", "business_unit", "country",
        _family_name(F.col("fam_no")).alias("dsp"),
        F.col("plays").alias("total_streams"))
    return revenue, streams
