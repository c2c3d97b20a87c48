"""Sums and ratios that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,6)"


def money_sum(amount: Column) -> Column:
    """Exact sum of money as decimal, so that any partitioning gives the same total."""
    return F.sum(amount.cast(MONEY))


def fill_zero(amount: Column) -> Column:
    """Double with null and NaN as 0."""
    return F.nanvl(F.coalesce(amount.cast("double"), F.lit(0.0)), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient; null when the whole is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
