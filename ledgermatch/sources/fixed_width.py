"""Fixed-width text extracts: one record per line, fields at fixed offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LEDGER_COLUMNS, Ledger

# (field, width) in file order; offsets follow from the widths
FieldSpec = Sequence[tuple[str, int]]


def ledger_layout(ledger: Ledger) -> list[tuple[str, int]]:
    """The extract layout: id 16, account 12, trade reference 12, BIC 12,
    three dates 10 each, currency 3, amount 20, D/C 1, narrative 24, status 10."""
    widths = {"account_number": 12, "trade_reference": 12, "swift_bic": 12, "transaction_date": 10,
              "value_date": 10, "settlement_date": 10, "currency": 3, "amount": 20, "debit_credit": 1,
              "narrative": 24, "status": 10}
    return [(ledger.id_col, 16)] + [(c, widths[c]) for c in LEDGER_COLUMNS]


def parse(lines: DataFrame, layout: FieldSpec, value_col: str = "value") -> DataFrame:
    """Cut each line into trimmed text fields; an all-blank field is NULL."""
    cols, start = [], 1
    for name, width in layout:
        text = F.trim(F.substring(F.col(value_col), start, width))
        cols.append(F.when(F.length(text) > 0, text).alias(name))
        start += width
    return lines.select(*cols, *[c for c in lines.columns if c != value_col])


def render(df: DataFrame, layout: FieldSpec) -> DataFrame:
    """One ``value`` line per row, each field left-aligned and blank-padded.

    A value that does not fit its field stops the write with its field and
    length: nothing is cut.
    """
    parts = []
    for name, width in layout:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        too_long = F.raise_error(F.concat(F.lit(f"{name} does not fit its {width} characters: length "),
                                          F.length(text).cast("string")))
        parts.append(F.when(F.length(text) > width, too_long.cast("string")).otherwise(F.rpad(text, width, " ")))
    return df.select(F.concat(*parts).alias("value"))
