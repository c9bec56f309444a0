"""File sources and sinks: CSV with declared schemas, parquet, JSON run summary.

* ``read_revenue_csv`` / ``read_streams_csv`` (S1): header CSV with an explicit
  schema (no inference pass over the data); ``infer=True`` is the opt-in.
* ``write_panel`` / ``read_panel`` (S2, S4): the harmonized panel as parquet
  partitioned by month, so month filters prune files.
* ``refresh_panel`` (S4): rewrites only the months that a late statement changed.
* ``write_outputs`` (S5, S6): deliverable, audits (parquet or CSV) and the
  one-row run summary as JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from fillwise.functions.safe import finite_or_null

REVENUE_SCHEMA = StructType([
    StructField("month", DateType()), StructField("business_unit", StringType()),
    StructField("territory_name", StringType()), StructField("dsp", StringType()),
    StructField("total_gross_amount", DoubleType())])
STREAMS_SCHEMA = StructType([
    StructField("month", DateType()), StructField("business_unit", StringType()),
    StructField("country", StringType()), StructField("dsp", StringType()),
    StructField("total_streams", LongType())])


def _read_csv(spark: SparkSession, path: str, schema: StructType, infer: bool) -> DataFrame:
    # a value that doesn't parse, or a header that isn't the schema's, stops the run
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema)
    return reader.csv(path)


def read_revenue_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    df = _read_csv(spark, path, REVENUE_SCHEMA, infer)
    return df.withColumn("total_gross_amount", finite_or_null("total_gross_amount"))


def read_streams_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return _read_csv(spark, path, STREAMS_SCHEMA, infer)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _by_month(df: DataFrame) -> DataFrame:
    """Rows of a month together, so that a month is few files; a hot month is split."""
    return df.hint("rebalance", "month")


def write_panel(panel: DataFrame, path: str) -> None:
    _by_month(panel).write.mode("overwrite").partitionBy("month").parquet(path)


def month_digests(panel: DataFrame) -> DataFrame:
    """(month, rows, digest): an order-free digest of each month's rows. Sums of two 63-bit hashes
    of a row; equal rows count as often as they come."""
    cols = sorted(c for c in panel.columns if c != "month")
    # a null is hashed as a mark of its own, as the hash functions skip it
    marked = [F.struct(F.col(c).isNull(), F.col(c)) for c in cols]
    parts = [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(salt), *marked), 1).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    return panel.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("|", *parts).alias("digest"))


def refresh_panel(panel: DataFrame, path: str) -> list:
    """S4 for a late statement: rewrite only the months whose rows differ from the saved panel's,
    and return them in order (None: rows without a month). A saved month that ``panel`` has no
    longer is emptied. ``panel`` must not read ``path``. Where nothing is saved, the whole panel is written.

    Months are compared by digest, so both panels are read once and only a row a month is
    joined. Changed months replace their folders by dynamic partition overwrite; the
    others' files stay as they are, byte for byte."""
    spark = panel.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = month_digests(panel)
    if not files.exists(at):
        write_panel(panel, path)
        return _sorted_months(new.select("month").collect())
    old = month_digests(read_panel(spark, path).select(*panel.columns)).select(
        F.col("month").alias("_month"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    both = new.join(old, F.col("month").eqNullSafe(F.col("_month")), "full")
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
    changed = both.where(~same).select(F.coalesce("month", "_month").alias("month"), F.col("rows").isNull().alias("gone")).collect()
    kept = [r["month"] for r in changed if not r["gone"]]
    if kept:  # at most the panel's months
        wanted = F.lit(False)
        for month in kept:
            wanted = wanted | F.col("month").eqNullSafe(F.lit(month).cast("date"))
        (_by_month(panel.where(wanted)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month").parquet(path))
    for r in changed:
        if r["gone"]:
            name = "__HIVE_DEFAULT_PARTITION__" if r["month"] is None else str(r["month"])
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(at, f"month={name}"), True)
    return _sorted_months(changed)


def _sorted_months(rows: list) -> list:
    return sorted((r["month"] for r in rows), key=lambda m: (m is not None, m))


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    cols = ["month", "business_unit", "territory_name", "dsp", "total_streams", "total_gross_amount",
            "is_na", "is_zero"]
    return df.withColumn("month", F.col("month").cast("date")).select(*cols)


def write_outputs(final: DataFrame, suspicious: DataFrame, reliability: DataFrame, summary: DataFrame,
                  path: str, fmt: str = "parquet") -> None:
    """S5 + S6: the deliverable and the two audits, then the run summary as JSON."""
    if fmt == "csv":
        write_csv(final, f"{path}/final_view")
        write_csv(suspicious, f"{path}/audit_suspicious_rows")
        write_csv(reliability, f"{path}/audit_dsp_month_reliability")
    else:
        _by_month(final).write.mode("overwrite").partitionBy("month").parquet(f"{path}/final_view")
        suspicious.write.mode("overwrite").parquet(f"{path}/audit_suspicious_rows")
        reliability.write.mode("overwrite").parquet(f"{path}/audit_dsp_month_reliability")
    write_summary(summary, f"{path}/run_summary")


def write_summary(summary: DataFrame, path: str) -> None:
    """The one-row run summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)
