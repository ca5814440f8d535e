"""Column expressions for standardising a raw ledger extract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DATE_PATTERN, DEBIT_CREDIT_CODES, Ledger

DATE_COLUMNS = ("settlement_date", "value_date", "transaction_date")
UPPER_TRIM_COLUMNS = ("account_number", "trade_reference", "currency", "swift_bic", "debit_credit")


def parse_date(c: str) -> Column:
    """Text date in the fixed pattern; anything unparseable becomes NULL (never raises)."""
    return F.try_to_date(F.col(c).cast("string"), DATE_PATTERN)


def upper_trim(c: str) -> Column:
    return F.upper(F.trim(F.col(c)))


def parse_amount(c: str = "amount", scale: float = 1.0) -> Column:
    """Amount as double; text that is not a number becomes NULL."""
    amount = F.col(c).try_cast("double")
    return amount / F.lit(float(scale)) if scale != 1.0 else amount


def normalised_columns(amount_scale: float = 1.0) -> dict[str, Column]:
    cols = {c: parse_date(c) for c in DATE_COLUMNS}
    cols.update({c: upper_trim(c) for c in UPPER_TRIM_COLUMNS})
    cols["amount"] = parse_amount("amount", amount_scale)
    return cols


def mandatory_ok(ledger: Ledger) -> Column:
    """Row passes the mandatory field and value rules.

    Never NULL: a NULL debit/credit code or amount counts as a failure,
    so every row lands in exactly one of clean or quarantine. Blank-only
    text (empty after trimming) and NaN amounts fail too. There is no upper
    bound on amounts.
    """
    present = [F.col(ledger.id_col).isNotNull()]
    for c in ("account_number", "trade_reference", "currency"):
        present.append(F.col(c).isNotNull() & (F.length(F.col(c)) > 0))
    present.append(F.col("settlement_date").isNotNull())
    amount = F.col("amount")
    rules = present + [amount.isNotNull(), ~F.isnan(amount), amount >= 0,
                       F.col("debit_credit").isin(*DEBIT_CREDIT_CODES)]
    ok = rules[0]
    for r in rules[1:]:
        ok = ok & r
    return F.coalesce(ok, F.lit(False))
