"""Run parameters and the fixed vocabulary of the reconciliation.

Everything tunable lives in one frozen dataclass that is passed explicitly;
nothing is read from ambient state inside a transformation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must stay exactly as written: they are the stored labels,
# --- key format and check names that downstream reports filter on) ---------
MATCHED = "MATCHED"
UNMATCHED = "UNMATCHED"
NEW = "NEW"
AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
CLEARED = "CLEARED"
STATUSES = (MATCHED, UNMATCHED, NEW, CLEARED, AMOUNT_MISMATCH)

KEY_FIELDS = ("account_number", "trade_reference", "settlement_date", "currency", "debit_credit")
KEY_SEPARATOR = "|"
KEY_NULL_TOKEN = "NULL"

DEBIT_CREDIT_CODES = ("D", "C")
DATE_PATTERN = "yyyy-MM-dd"
REJECTION_REASON = "mandatory_field_or_value_check_failed"
RESCUED = "_rescued_line"  # a landing line that does not fit its header, whole

CHECK_COMPLETENESS = "completeness"
CHECK_DUPLICATES = "duplicate_rate"
CHECK_NEGATIVE = "negative_amounts"
CHECK_SCHEMA = "schema_enforcement"
PASS, FAIL = "PASS", "FAIL"

# columns every ledger extract carries after its id column
LEDGER_COLUMNS = (
    "account_number", "trade_reference", "swift_bic", "transaction_date", "value_date",
    "settlement_date", "currency", "amount", "debit_credit", "narrative", "status",
)

# mismatch reasons for the exception report (one per non-matched class)
REASON_AMOUNT = "AMOUNT"
REASON_MISSING_IN_RADA = "MISSING_IN_RADA"
REASON_MISSING_IN_CASH = "MISSING_IN_CASH"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Ledger:
    """One side of the reconciliation: its name and its record-id column."""

    name: str
    id_col: str
    settled_status: str

    @property
    def required_cols(self) -> tuple[str, ...]:
        return (self.id_col, "account_number", "trade_reference", "settlement_date", "currency", "amount")


CASH = Ledger("cash", "cash_id", "SETTLED")
RADA = Ledger("rada", "rada_id", "CONFIRMED")

@dataclass(frozen=True)
class ReconConfig:
    amount_tolerance: float = 1.00
    completeness_threshold: float = 0.98
    duplicate_threshold: float = 0.005
    lookback_days: int = 5
    # RADA may deliver minor units (cents); amounts are divided by this
    rada_amount_scale: float = 1.0
    # a CLEARED key must also be MATCHED today (off = vanished from unmatched)
    cleared_requires_match: bool = False
    time_zone: str = "Africa/Johannesburg"
    gold_cluster_cols: tuple[str, ...] = field(default=("recon_status", "settlement_date", "currency"))
