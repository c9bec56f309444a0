"""Small table idioms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def replace_by_key(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop the table's rows whose key appears in ``rows``, then append ``rows``
    (an idempotent upsert of, e.g., one model's metric record)."""
    return table.join(rows.select(*key).distinct(), list(key), "left_anti").unionByName(rows)
