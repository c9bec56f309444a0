"""Driver tables: one parquet file (or folder) per table."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read a driver table; selecting ``columns`` right at the scan keeps the
    parquet ReadSchema to what the query needs."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
