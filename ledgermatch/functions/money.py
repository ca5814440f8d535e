"""Exact money sums and guarded ratios.

Summing doubles depends on the order rows arrive in, which differs between
runs and engines. Money is summed as DECIMAL(38,6): every amount keeps its
fraction (to six places) and totals up to 10^32 are exact; rounding to the
reported places comes after the sum. An amount without a decimal value
(infinite, or beyond 32 digits) is left out of sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"


def money_sum(c: Column) -> Column:
    """Exact sum of a double money column; NULL when no non-null input."""
    return F.sum(c.try_cast(MONEY)).cast("double")


def ratio(num: Column, den: Column, digits: int, *, scale: float = 1.0) -> Column:
    """``round(num / den * scale, digits)``, 0.0 when the denominator is 0."""
    value = num.cast("double") / den.cast("double")
    if scale != 1.0:
        value = value * F.lit(float(scale))
    return F.when(den > 0, F.round(value, digits)).otherwise(F.lit(0.0))
