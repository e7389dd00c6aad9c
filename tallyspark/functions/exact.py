"""Exact aggregate helpers: results that do not depend on partitioning or engine.

Averages of money columns are computed as exact decimal ratios and rounded once
(half-up), so repartitioning the input never changes a digit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(c, scale_in: int, k: int) -> Column:
    """ROUND(AVG(c), k) for a decimal column with ``scale_in`` fractional digits (double out)."""
    c = F.col(c) if isinstance(c, str) else c
    units = (c * (10 ** scale_in)).cast("bigint")
    ratio = F.try_divide(F.sum(units).cast("decimal(20,0)"), F.count(units).cast("decimal(20,0)"))
    rounded = F.round(ratio, k - scale_in) if k >= scale_in else F.round(ratio, k - scale_in)
    return (rounded * F.lit(Decimal(1).scaleb(-scale_in))).cast("double")


def round_double(c, k: int) -> Column:
    """Round a floating statistic for presentation (half-up on its decimal form)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), k)


def count_bigint() -> Column:
    return F.count(F.lit(1)).cast("bigint")
