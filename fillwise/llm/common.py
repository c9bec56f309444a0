"""Shared helpers of the corpus operators: inputs, shipping the package to the
executors, tables in the shared checkpoint folder, packing rows into blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.session import cut_lineage, ship

#: Bytes of output that a Python task gathers before it hands a batch to Spark.
OUT_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    ship(df.sparkSession)
    return cut_lineage(df)


def partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def bucket(text: Column | str, seed: str, n: int) -> Column:
    """Deterministic bucket 0..n-1 of a value; the same in any engine that has md5."""
    c = F.col(text) if isinstance(text, str) else text
    digest = F.md5(F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit(f"#{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)


def out_batches(rows: Iterable[tuple], schema: pa.Schema, weigh=None) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weigh(row) if weigh else sum(len(v) if isinstance(v, (bytes, str)) else 8 for v in row)
        if size >= OUT_BYTES or len(held) >= 10_000:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


#: Rows up to which a narrow stored table is broadcast; beyond, the join shuffles.
SMALL_ROWS = 20_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint for a stored narrow table of at most ``rows`` rows, found by counting
    it; a larger one is joined by shuffling."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
