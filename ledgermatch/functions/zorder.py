"""Z-order codes: one number that keeps rows near in several columns near each other.

Each column is reduced to its range rank, the number of the column's quantiles at or
below the value, scaled to ``bits`` bits, so a column of few values spreads over the high
bits like one of many. The ranks' bits are interleaved, the highest of every column first.
All of it is expressions; the quantiles are one small aggregate (``2^bits - 1`` numbers per
column, all that passes through the driver).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, TimestampType

BITS = 6
_PREFIX = 7  # leading bytes of a text that fit a long


def order_number(name: str, kind: DataType) -> Column:
    """A number in the order of the column's values (of a text, of its first bytes)."""
    value = F.col(name)
    if isinstance(kind, (NumericType, BooleanType)):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    text = value.cast("string").cast("binary")
    digits = F.rpad(F.hex(F.substring(text, 1, _PREFIX)), 2 * _PREFIX, "0")
    return F.conv(digits, 16, 10).cast("double")


def quantiles(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Distinct quantiles of each column, ascending, without the least value."""
    steps = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.array_distinct(F.percentile_approx(order_number(c, df.schema[c].dataType), steps, 1000)).alias(c)
                   for c in cols], *[F.min(order_number(c, df.schema[c].dataType)).alias(f"least {c}") for c in cols]).first()
    return {c: [v for v in row[c] or () if v > row[f"least {c}"]] for c in cols}


def _rank(value: Column, marks: Sequence[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, marks)), lambda m: m <= value)) if marks else F.lit(0)


def z_code(df: DataFrame, bounds: Mapping[str, Sequence[float]], bits: int = BITS) -> Column:
    """The interleaved range ranks; a null comes before every value."""
    if bits * len(bounds) > 63:
        raise ValueError(f"{len(bounds)} columns of {bits} bits do not fit a long")
    code = F.lit(0).cast("long")
    for place, (name, marks) in enumerate(bounds.items()):
        value = order_number(name, df.schema[name].dataType)
        rank = _rank(value, marks)
        scaled = F.coalesce(F.floor(F.when(value.isNotNull(), rank) * F.lit(2**bits) / F.lit(len(marks) + 1)), F.lit(0)).cast("long")
        for bit in range(bits):
            code = code + F.shiftleft(F.shiftright(scaled, bit).bitwiseAND(F.lit(1).cast("long")),
                                      bit * len(bounds) + len(bounds) - 1 - place)
    return code
