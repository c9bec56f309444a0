"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets: the sources, by code point (null last), carry the weights in turn and share
``share`` times all words; a target stops at ``cap`` times its source's words and the
excess goes to the others by weight (water filling, solved in closed form over the sorted
source table). The words are dealt in blocks of ``block`` words: the mix's blocks go to
sources by the highest quotients target / (2k - 1), a source's blocks to its shards by the
highest quotients words / (2k - 1). Only the last few quotients of each party compete (its
first ones are certain), so nothing is enumerated that grows with the block count. Within a
shard the rows stand in a seeded order, are cut into blocks, and the quota takes every block
as often as it fits and once more a seeded circular run of blocks.

A source is split into shards by a seeded hash of the key, so a source that holds a third
of all rows is dealt over many tasks. Only built-in DataFrame functions are used.

Rows: null text or no word gives size 0 and nothing is taken; a null source is a source of
its own; a null key hashes like an empty one; repeated rows each count and are taken each.
An empty table gives an empty result. All decisions are in one struct column, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillwise.llm.common import bucket, small_side, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Words in a block, words in a shard, and shards of a source at most (shards then grow).
BLOCK = 16
SHARD_WORDS = 1_000_000
SHARDS_MOST = 100_000
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """(source, words) -> plus idx, target. One row per source, so single windows."""
    everything = Window.partitionBy()
    by_ratio = everything.orderBy(F.col("words") / F.col("weight"), "idx")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    d = (sources
         .withColumn("idx", F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")).cast("long"))
         .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                            ((F.col("idx") - 1) % len(weights) + 1).cast("int")).cast("double"))
         .withColumn("capped", (cap * F.col("words")).cast("double"))
         .withColumn("left", F.lit(share) * F.sum("words").over(everything)
                     - F.coalesce(F.sum("capped").over(before), F.lit(0.0)))
         # the fill level if this source and those after it are not capped
         .withColumn("level", F.col("left") / F.sum("weight").over(onward))
         .withColumn("fits", F.col("level") * F.col("weight") <= F.col("capped")))
    level = F.max(F.when(F.col("fits"), F.col("level"))).over(everything)
    # the level falls while sources that can't fill it leave, then rises no more
    return d.withColumn("target", F.least("capped", F.col("weight") * F.coalesce(level, F.lit(0.0)))).select(
        "source", "words", "idx", "target")


def apportion(parties: DataFrame, by: Sequence[str], weight: str, seats: str, order: str) -> DataFrame:
    """``parties`` with ``quota``: Sainte-Laguë seats of each party within its ``by`` group.

    With n parties the divisors total / (seats -+ n/2) give a party at least and at most
    so many seats; between the two (about 4 n in all) the highest quotients decide.
    """
    group = Window.partitionBy(*by)
    share = F.try_divide(F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(group))
    half = F.count(F.lit(1)).over(group) / 2.0
    sure = F.greatest(F.lit(0), F.floor(share * (F.col(seats) - half) + 0.5) - 1).cast("long")
    most = F.greatest(F.lit(0), F.floor(share * (F.col(seats) + half) + 0.5) + 1).cast("long")
    d = (parties.withColumn("_sure", F.coalesce(sure, F.lit(0))).withColumn("_most", F.coalesce(most, F.lit(0)))
         .withColumn("_open", F.col(seats) - F.sum("_sure").over(group)))
    bids = (d.where(F.col("_most") > F.col("_sure"))
            .withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
            .withColumn("_q", F.col(weight).cast("double") / (2 * F.col("_k") - 1))
            .withColumn("_rank", F.row_number().over(group.orderBy(F.desc("_q"), order, "_k")))
            .where(F.col("_rank") <= F.col("_open")))
    won = bids.groupBy(*by, order).agg(F.count(F.lit(1)).alias("_won"))
    on = list(dict.fromkeys([*by, order]))
    return (d.join(won, on, "left")
            .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
            .drop("_sure", "_most", "_open", "_won"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", size: Column | None = None,
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, block: int = BLOCK,
        shard_words: int = SHARD_WORDS, seed: str = SEED, tie: Column | None = None) -> DataFrame:
    """``docs`` with a struct column ``_mix`` (it replaces one of this name): size, source_size,
    target, taken, passes (whole readings) and parts (up to two word ranges [from, to) that are
    read once more)."""
    size = n_words(F.col("text")) if size is None else size
    # the row is one struct beside this function's own columns, so its names can't clash with them
    own = [c for c in docs.columns if c.lower() != "_mix"]
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_of"),
                       size.alias("_size"), (F.lit(None).cast("long") if tie is None else tie).alias("_tie"))
    sources = stored(rows.groupBy(F.col("_of").alias("source")).agg(F.sum("_size").alias("words")))
    goal = targets(sources, weights, share, cap)
    goal = (goal.withColumn("blocks", F.floor(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
            .withColumn("all", F.lit(0))
            .withColumn("shards", F.greatest(F.lit(1), F.least(F.lit(SHARDS_MOST), F.ceil(F.col("words") / shard_words)))))
    goal = stored(apportion(goal, ["all"], "target", "blocks", "idx").withColumnRenamed("quota", "seats"))

    plan = small_side(goal.select(F.col("source").alias("_source"), "idx", "shards", "words", "target"))
    placed = (rows.join(plan, F.col("_of").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("_shard", bucket("_key", seed + "/shard", 1 << 31) % F.col("shards")))
    shards = stored(placed.groupBy("idx", "_shard").agg(F.sum("_size").alias("shard_words")))
    shards = shards.join(small_side(goal.select("idx", "seats")), "idx")
    quotas = apportion(shards, ["idx"], "shard_words", "seats", "_shard")
    n = F.ceil(F.col("shard_words") / block)
    quotas = (quotas.withColumn("_n", n)
              .withColumn("_quota", F.least(F.col("quota"), cap * F.col("_n")))
              .withColumn("_passes", F.coalesce(F.floor(F.try_divide(F.col("_quota"), F.col("_n"))), F.lit(0)))
              .withColumn("_extra", F.col("_quota") - F.col("_passes") * F.col("_n"))
              .withColumn("_from", F.coalesce(F.try_mod(
                  bucket(F.concat_ws("/", "idx", "_shard"), seed + "/from", 1 << 31), F.col("_n")), F.lit(0)))
              .select("idx", "_shard", "_n", "_passes", "_extra", "_from"))

    line = Window.partitionBy("idx", "_shard").orderBy(
        F.md5(F.concat(F.coalesce(F.col("_key").cast("string"), F.lit("")), F.lit(f"#{seed}/order")).cast("binary")),
        "_key", "_size", "_tie")
    d = (placed.withColumn("_end", F.sum("_size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .join(quotas, ["idx", "_shard"]))
    start, end = F.col("_end") - F.col("_size"), F.col("_end")
    stop = F.col("_from") + F.col("_extra")

    def part(lo: Column, hi: Column) -> Column:
        a = F.greatest(start, lo * block)
        b = F.least(end, hi * block)
        return F.struct((a - start).cast("long").alias("from"), (F.greatest(a, b) - start).cast("long").alias("to"))

    parts = F.filter(F.array(part(F.col("_from"), F.least(stop, F.col("_n"))), part(F.lit(0), stop - F.col("_n"))),
                     lambda p: p["to"] > p["from"])
    d = d.withColumn("_parts", parts)
    more = F.aggregate("_parts", F.lit(0).cast("long"), lambda s, p: s + p["to"] - p["from"])
    return d.select("_row.*", F.struct(
        F.col("_size").alias("size"), F.col("words").cast("long").alias("source_size"), F.col("target"),
        (F.col("_passes") * F.col("_size") + more).cast("long").alias("taken"),
        F.col("_passes").cast("long").alias("passes"), F.col("_parts").alias("parts")).alias("_mix"))
