"""ledgermatch: two-ledger transaction reconciliation on Spark DataFrames."""

from .config import CASH, RADA, ReconConfig

__all__ = ["CASH", "RADA", "ReconConfig"]
__version__ = "0.1.0"
