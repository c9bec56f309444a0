"""Order-independent money totals.

A double sum depends on the order rows arrive in, so two runs (or two engines)
can disagree in the last digits. Totals that are reported are summed as
DECIMAL(38, 15), which is exact, and turned back into a double at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fillwise.functions.safe import col

MONEY_DECIMAL = "decimal(38,15)"


def exact(c: str | Column) -> Column:
    """A money column as the decimal that its double prints as."""
    return col(c).cast(MONEY_DECIMAL)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column (NULL for no values, like SQL SUM)."""
    return F.sum(exact(c)).cast("double")


def money_mean(c: str | Column) -> Column:
    """Mean of a money column from its exact sum (NULLs skipped, like AVG)."""
    return money_sum(c) / F.count(col(c))
