"""Exact rank selection that stays distributed: quantiles and k-smallest.

``percentile(x, q)`` is exact but merges every distinct value of a group into one
aggregation buffer, so a global or hot-group quantile over billions of rows ends
up in one task; a ``row_number()`` window has the same problem for a hot group.
Here a value at a given rank is found without either:

1. collapse duplicates: ``(by, x) -> count`` with map-side combine, so a hot value
   is one row;
2. range-partition and sort the distinct values on ``(by, x)``, so a hot group is spread over
   many tasks, and cut each task's run into slices of a fixed number of values, so
   slices grow in number with the data, not in size; the slice id is stored with the rows in a table written to the
   shared checkpoint folder, so every reader (and every retry) sees the same slices;
3. per (slice, group) counts give each slice's rank offset (a table of at most
   slices + groups rows);
4. only the slices holding the wanted ranks are re-read and ranked locally.

The same steps run at every size.

``exact_quantiles`` gives pandas' ``Series.quantile`` / DuckDB's ``quantile_cont``
(linear interpolation, computed as lo + t * (hi - lo) like DuckDB; numpy's
hi - (1 - t) * (hi - lo) for t >= 0.5 can differ in the last bit); ``smallest_k`` keeps the k rows with the smallest key per
group. ``quantile_partial`` (built-in ``percentile``) is only for groups with a
proven small size, such as 30 backtest repeats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillwise.functions.joins import lookup_join
from fillwise.session import cut_lineage


#: Values of a slice: 1 << SLICE_BITS at most, whatever the size of the data.
SLICE_BITS = 9


def _slices(df: DataFrame, value: str | Column, by: list[str], n_slices: int | None
            ) -> tuple[DataFrame, DataFrame]:
    """(ranged distinct values with slice id, per-(slice, group) rank offsets)."""
    spark = df.sparkSession
    n_slices = n_slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    x = F.col(value) if isinstance(value, str) else value
    keyed = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    for b in by:
        keyed = keyed.where(F.col(b).isNotNull())
    distinct = keyed.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    # places run through the ranges in order, so every SLICE of them is one run of values
    ranged = cut_lineage(distinct.repartitionByRange(n_slices, *by, "_x").sortWithinPartitions(*by, "_x")
                         .withColumn("_s", F.shiftright(F.monotonically_increasing_id(), SLICE_BITS)))
    by_group = Window.partitionBy(*by) if by else Window.partitionBy()
    stats = (ranged.groupBy("_s", *by).agg(F.sum("_c").alias("_cnt"))
             .withColumn("_off", F.coalesce(F.sum("_cnt").over(
                 by_group.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_n", F.sum("_cnt").over(by_group)))
    return ranged, stats


def _pick(ranged: DataFrame, stats: DataFrame, requests: DataFrame, by: list[str],
          bound: int | None) -> DataFrame:
    """Values at 0-based ranks. ``requests``: (by..., _req, _rank) -> (by..., _req, _x)."""
    joined = stats.crossJoin(F.broadcast(requests)) if not by else lookup_join(stats, requests, by, "inner")
    targets = (joined
               .where((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_cnt")))
               .select("_s", *by, "_req", (F.col("_rank") - F.col("_off")).alias("_local")))
    hot = lookup_join(ranged, targets.select("_s", *by).distinct(), ["_s", *by], "left_semi", bound=bound)
    local = Window.partitionBy("_s", *by).orderBy("_x")
    ranked = hot.withColumn("_end", F.sum("_c").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_c"))
    return (lookup_join(ranked, targets, ["_s", *by], "inner", bound=bound)
            .where((F.col("_local") >= F.col("_start")) & (F.col("_local") < F.col("_end")))
            .select(*by, "_req", "_x"))


def exact_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                    by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """One row per ``by`` group that has a non-null value; one column per prob.

    NULL and NaN values are skipped (pandas skips NaN). Groups with a NULL key
    are dropped, as pandas ``groupby`` does.
    """
    by = list(by)
    x = F.col(value).cast("double")
    known = df.select(*by, x.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ranged, stats = _slices(known, "_v", by, slices)
    targets = _targets(stats, probs, by)
    bound = 2 * len(probs) if not by else None
    hot = lookup_join(ranged, targets.select("_s", *by).distinct(), ["_s", *by], "left_semi", bound=bound)
    return _interpolated(hot, targets, probs, by, bound)


def _targets(stats: DataFrame, probs: Mapping[str, float], by: list[str]) -> DataFrame:
    """(slice, by..., _n, _req, _local): the slices that hold wanted ranks. The requests come
    straight from the (slice, group) rows, which know the group size."""
    wanted = F.array(*[F.struct(F.lit(f"{side}_{name}").alias("_req"), F.lit(float(q)).alias("_p"),
                                F.lit(side).alias("_side"))
                       for name, q in probs.items() for side in ("lo", "hi")])
    pos = F.col("_w._p") * (F.col("_n") - F.lit(1))
    rank = F.when(F.col("_w._side") == "lo", F.floor(pos)).otherwise(F.ceil(pos))
    return (stats.select("_s", *by, "_off", "_cnt", "_n", F.explode(wanted).alias("_w"))
            .select("_s", *by, "_off", "_cnt", "_n", F.col("_w._req").alias("_req"), rank.alias("_rank"))
            .where((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_cnt")))
            .select("_s", *by, "_n", "_req", (F.col("_rank") - F.col("_off")).alias("_local")))


def _interpolated(hot: DataFrame, targets: DataFrame, probs: Mapping[str, float], by: list[str],
                  bound: int | None) -> DataFrame:
    """Quantiles from the values (_x, counted _c times) of the target slices."""
    local = Window.partitionBy("_s", *by).orderBy("_x")
    ranked = hot.withColumn("_end", F.sum("_c").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_c"))
    picked = (lookup_join(ranked, targets, ["_s", *by], "inner", bound=bound)
              .where((F.col("_local") >= F.col("_start")) & (F.col("_local") < F.col("_end"))))
    pivot = picked.groupBy(*by).agg(F.max("_n").alias("_n"),
                                    *[F.max(F.when(F.col("_req") == r, F.col("_x"))).alias(f"_{r}")
                                      for name in probs for r in (f"lo_{name}", f"hi_{name}")])
    outs = []
    for name, q in probs.items():
        p = F.lit(float(q)) * (F.col("_n") - F.lit(1))
        frac = p - F.floor(p)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outs.append(F.when(frac == 0, lo).otherwise(lo + frac * (hi - lo)).alias(name))
    return pivot.select(*by, *outs)


def quantiles_without(pool: DataFrame, held: DataFrame, value: str, probs: Mapping[str, float], copies,
                      copy: str, by: Sequence[str] = ()) -> DataFrame:
    """Per (copy, by) the exact quantiles of the pool without the rows that ``held`` has under
    this copy; one pass over the pool, not one for each copy.

    The distinct values of the pool are sliced by range once. Slice counts are additive, so a
    copy's counts are the pool's less its own held rows'; these give the slices
    in which its wanted ranks lie, and only there are values ranked under deletion.
    ``copies(df)`` repeats the few rows of slice counts for every copy; ``held`` has the columns
    of the pool and ``copy``, and its rows are rows of the pool."""
    by = list(by)
    x = F.col(value).cast("double")

    def known(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.select(*keys, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))

    ranged, stats = _slices(known(pool, by), "_x", by, None)
    gone = known(held, [copy, *by]).groupBy(copy, *by, "_x").agg(F.count(F.lit(1)).alias("_h"))
    gone = cut_lineage(gone.join(ranged.select(*by, "_x", "_s"), [*by, "_x"]))
    less = gone.groupBy(copy, *by, "_s").agg(F.sum("_h").alias("_h"))
    keys = [copy, *by]
    left = lookup_join(copies(stats.select("_s", *by, "_cnt")), less, [*keys, "_s"], "left")
    left = left.withColumn("_cnt", F.col("_cnt") - F.coalesce("_h", F.lit(0)))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    left = left.select("_s", *keys, "_cnt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                       F.sum("_cnt").over(group).alias("_n"))
    targets = cut_lineage(_targets(left, probs, keys))
    hot = ranged.join(targets.select("_s", *keys).distinct(), ["_s", *by])
    hot = lookup_join(hot, gone.select(*keys, "_x", "_h"), [*keys, "_x"], "left")
    hot = hot.withColumn("_c", F.col("_c") - F.coalesce("_h", F.lit(0))).drop("_h").where(F.col("_c") > 0)
    return _interpolated(hot, targets, probs, keys, None)


def grouped_and_global_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                                 groups: Sequence[str], by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Per-(by, groups) and per-(by) quantiles from ONE rank-selection pass.

    The rows are stacked twice with a level key (the global copy has its group
    columns blanked), so the slicing, offsets and picking run once for both levels.
    Group columns must be strings.
    """
    by, groups = list(by), list(groups)
    rows = df.select(*by, *groups, F.col(value).alias("_v"))
    stacked = (rows.select(*by, *groups, "_v", F.lit(0).alias("_lvl"))
               .unionByName(rows.select(*by, *[F.lit("").alias(g) for g in groups], "_v", F.lit(1).alias("_lvl"))))
    q = exact_quantiles(stacked, "_v", probs, [*by, "_lvl", *groups])
    per_group = q.where(F.col("_lvl") == 0).drop("_lvl")
    glob = q.where(F.col("_lvl") == 1).drop("_lvl", *groups)
    return per_group, glob


def kth_smallest(df: DataFrame, key: str, k: DataFrame, by: Sequence[str], slices: int | None = None) -> DataFrame:
    """Per ``by`` group, the ``k._k``-th smallest ``key`` (or the largest when the
    group has fewer rows): (by..., _cut). Groups with ``_k <= 0`` are absent."""
    by = list(by)
    keyed = df.select(*by, F.col(key).alias("_x")).where(F.col("_x").isNotNull())
    ranged, stats = _slices(keyed, "_x", by, slices)
    sizes = stats.select(*by, "_n").distinct()
    req = (lookup_join(sizes, k.select(*by, "_k"), by, "inner")
           .where(F.col("_k") > 0)
           .select(*by, F.lit("k").alias("_req"), (F.least(F.col("_k"), F.col("_n")) - 1).alias("_rank")))
    return _pick(ranged, stats, req, by, None).select(*by, F.col("_x").alias("_cut"))


def flag_smallest_k(df: DataFrame, key: str, k: DataFrame, by: Sequence[str], flag: str,
                    slices: int | None = None) -> DataFrame:
    """``df`` with ``flag`` true on the rows whose ``key`` is among the ``k._k``
    smallest of their ``by`` group. Keys are assumed distinct within a group."""
    cut = kth_smallest(df, key, k, by, slices)
    out = lookup_join(df, cut, list(by), "left")
    return out.withColumn(flag, F.coalesce(F.col(key) <= F.col("_cut"), F.lit(False))).drop("_cut")


def smallest_k(df: DataFrame, key: str, k: DataFrame, by: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the ``k._k`` smallest of its ``by`` group."""
    cut = kth_smallest(df, key, k, by, slices)
    return lookup_join(df, cut, list(by), "inner").where(F.col(key) <= F.col("_cut")).drop("_cut")


def quantile_partial(df: DataFrame, value: str, probs: Mapping[str, float],
                     by: Sequence[str] = ()) -> DataFrame:
    """Built-in ``percentile``: one buffer per group; only for small groups."""
    x = F.col(value).cast("double")
    keyed = df.where(x.isNotNull() & ~F.isnan(x))
    aggs = [F.percentile(x, float(q)).alias(name) for name, q in probs.items()]
    return keyed.groupBy(*by).agg(*aggs) if by else keyed.agg(*aggs)


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
              method: str = "exact") -> DataFrame:
    if method == "partial":
        return quantile_partial(df, value, probs, by)
    return exact_quantiles(df, value, probs, by)


def global_quantiles(df: DataFrame, value: str, probs: Mapping[str, float],
                     method: str = "exact") -> DataFrame:
    """Exactly one row, NULL columns when there is no value (like pandas' NaN)."""
    q = quantiles(df, value, probs, (), method)
    return q.agg(*[F.max(name).alias(name) for name in probs])
