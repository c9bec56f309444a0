"""Connected components of an edge list, by alternating large-star and small-star steps.

Every step replaces a node's edges by edges to its smallest neighbour, so the list never
grows beyond its edges and ends as one star around each component's smallest node. Steps
are joins and min-aggregations (a hub with very many edges is pre-aggregated, and the join
back can be split), and each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of longs -> (node, component): the smallest node reachable, for every node with
    an edge to another. Null ends and loops are ignored; repeats and direction don't matter."""
    # hi > lo always
    e = stored(edges.where(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    state = _state(e)
    while state[0]:
        e = stored(_small_star(_large_star(e)))
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.col("lo").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (e.join(least, "hi").where(F.col("lo") != F.col("m"))
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
