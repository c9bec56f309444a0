"""Join helpers with an explicit broadcast policy.

* ``lookup_join`` with ``bound=`` broadcasts a lookup whose row count has a proven
  upper bound (a closed vocabulary such as the DSP families, or one row per
  backtest repeat). Without a bound the join is left to AQE, which turns it into a
  broadcast join only after measuring the materialized side and keeps a
  sort-merge join beyond ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
* ``attach_scalars`` joins a global aggregate (exactly one row per ``by`` group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookups above this many rows are never hinted, whatever bound the caller proves.
MAX_HINTED_ROWS = 100_000


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
                bound: int | None = None) -> DataFrame:
    on = list(on)
    if bound is not None and bound <= MAX_HINTED_ROWS:
        lookup = F.broadcast(lookup)
    return df.join(lookup, on=on, how=how)


def attach_scalars(df: DataFrame, scalars: DataFrame, by: Sequence[str] = (),
                   bound: int | None = 1) -> DataFrame:
    """Attach a global (or per-``by``) one-row aggregate to every row.

    With no ``by`` keys the aggregate has exactly one row, so the cross join is a
    broadcast nested-loop join against a single row.
    """
    by = list(by)
    if not by:
        # Exactly one row, even when the source was empty (a GROUPING SETS
        # aggregate over no rows yields no grand-total row): max() over at most
        # one row is that row, over none a row of NULLs.
        one = scalars.agg(*[F.max(c).alias(c) for c in scalars.columns])
        return df.crossJoin(F.broadcast(one))
    return lookup_join(df, scalars, by, "left", bound=bound)
