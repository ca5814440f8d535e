"""Explicit ledger schemas and typed column contracts."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import LEDGER_COLUMNS, Ledger


def landing_schema(ledger: Ledger, *, amount_as_text: bool = False) -> T.StructType:
    """Schema of a landing extract (CSV): every field text except the amount.

    The id, account and trade reference are declared non-null as in the
    extract contract; note that file sources do not enforce the flag, the
    standardisation step does.
    """
    fields = [T.StructField(ledger.id_col, T.StringType(), False)]
    for name in LEDGER_COLUMNS:
        dtype = T.DoubleType() if (name == "amount" and not amount_as_text) else T.StringType()
        nullable = name not in ("account_number", "trade_reference")
        fields.append(T.StructField(name, dtype, nullable))
    return T.StructType(fields)


def silver_schema(ledger: Ledger) -> T.StructType:
    """Typed ledger after standardisation."""
    fields = [T.StructField(ledger.id_col, T.StringType(), True)]
    for name in LEDGER_COLUMNS:
        if name == "amount":
            dtype = T.DoubleType()
        elif name.endswith("_date"):
            dtype = T.DateType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def type_contract(ledger: Ledger) -> dict[str, str]:
    """Required columns with the Spark simple type name they must carry in silver."""
    types = {f.name: f.dataType.simpleString() for f in silver_schema(ledger).fields}
    return {c: types[c] for c in ledger.required_cols}
