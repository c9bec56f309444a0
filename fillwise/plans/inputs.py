"""Inputs of every query: the two facts and the label map from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fillwise.sources.fixtures import fixture_label_map, revenue_streams


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(revenue, streams, label_map)."""
    revenue, streams = revenue_streams(spark, sf_dir)
    return revenue, streams, fixture_label_map(spark)
