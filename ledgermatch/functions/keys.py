"""Deterministic business keys: SHA-256 over the matching fields.

The hashed text is the stored key format (``KEY_FIELDS``, ``KEY_SEPARATOR``,
``KEY_NULL_TOKEN`` in ``config``); the same record yields the same key on
either ledger, so the matcher joins on one column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KEY_FIELDS, KEY_NULL_TOKEN, KEY_SEPARATOR, LEDGER_COLUMNS

# ledger columns that matching does not read
_NOT_MATCHED = ("transaction_date",)


def key_text(fields: Sequence[str] = KEY_FIELDS) -> Column:
    """The text a key is the digest of; kept beside the key for audit."""
    values = F.array(*(F.col(f).cast("string") for f in fields))
    return F.array_join(values, KEY_SEPARATOR, KEY_NULL_TOKEN)


def prepare_for_matching(silver: DataFrame, id_col: str, fields: Sequence[str] = KEY_FIELDS) -> DataFrame:
    """The ledger's matching columns after its key and the key's text."""
    text = key_text(fields)
    kept = [c for c in LEDGER_COLUMNS if c not in _NOT_MATCHED]
    return silver.select(F.sha2(text, 256).alias("business_key"), text.alias("key_input"), id_col, *kept)
