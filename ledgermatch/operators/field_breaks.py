"""Field-level breaks: open records that would pair but for one field.

A cash record left UNMATCHED and a RADA record left NEW belong together when four of
the five key fields agree, the fifth does not, and the amounts are within the
tolerance. The result names the field and both values; records that share a
key but not the amount (AMOUNT_MISMATCH) are listed with the field ``amount``.

Plan: leave-one-field-out blocking. Each open record is stated five times, under the
digest of the other four fields, and the two sides are joined by equality of the
block. Within a block the matcher's pairing applies (``match.pair_records``: as many
pairs within the tolerance as possible, one per record), so a block with very many
records on both sides is spread like a hot key and never becomes all pairs. A record
then has at most five candidates. They are resolved one-to-one: a pair stands
when it is the best of both its records - by difference of the amounts, then the order of
the key fields, then the identifiers - and rounds go on over the records that are
still free until no candidate is left. Every round settles at least the best
candidate of each group that hangs together.

Defined results: a null field agrees with a null field; unknown amounts are within no
tolerance; empty inputs give no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AMOUNT_MISMATCH, CASH, KEY_FIELDS, NEW, RADA, UNMATCHED, ReconConfig
from ..functions.keys import key_text
from ..session import checkpoint_root
from .match import exact, pair_records

AMOUNT_FIELD = "amount"
BREAK_COLUMNS = ("cash_id", "rada_id", "field", "cash_value", "rada_value", "amount", "rada_amount")


def _blocks(records: DataFrame, id_col: str) -> DataFrame:
    """Each record under each field that may differ: (business_key, id, amount, value)."""
    stated = F.array(*(F.struct(
        F.concat_ws(":", F.lit(field), F.sha2(key_text([f for f in KEY_FIELDS if f != field]), 256)).alias("block"),
        F.col(field).cast("string").alias("value")) for field in KEY_FIELDS))
    return records.select(id_col, AMOUNT_FIELD, F.explode(stated).alias("_s")).select(
        F.col("_s.block").alias("business_key"), id_col, AMOUNT_FIELD, F.col("_s.value").alias("value"))


def candidates(cash: DataFrame, rada: DataFrame, cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """(cash_id, rada_id, field, both values, both amounts, gap) of open records
    that differ in one field; a record is in at most one row per field."""
    pairs = pair_records(
        _blocks(cash, CASH.id_col).withColumnRenamed("value", "cash_value"),
        _blocks(rada, RADA.id_col).withColumnRenamed("value", "rada_value"), cfg.amount_tolerance,
        payload=("cash_value",), rada_payload=("rada_value",))
    gap = F.abs(exact(F.col("_cash_amount")) - exact(F.col("_rada_amount")))
    near = pairs.withColumn("gap", gap).filter(F.col("gap") <= F.lit(repr(float(cfg.amount_tolerance))).cast("decimal(38,6)"))
    return near.filter(~F.col("cash_value").eqNullSafe(F.col("rada_value"))).select(
        "cash_id", "rada_id", F.substring_index("business_key", ":", 1).alias("field"), "cash_value", "rada_value",
        F.col("_cash_amount").alias("amount"), F.col("_rada_amount").alias("rada_amount"), "gap")


def _best() -> Column:
    """What makes one candidate better than another: one order for both sides."""
    place = F.array_position(F.array(*map(F.lit, KEY_FIELDS)), F.col("field"))
    return F.struct("gap", place.alias("place"), "cash_id", "rada_id")


def resolve(edges: DataFrame) -> DataFrame:
    """One-to-one: the candidates that stand."""
    checkpoint_root(edges.sparkSession)
    left, settled = edges.withColumn("_best", _best()).checkpoint(eager=True), []
    while not left.isEmpty():
        of = [F.min("_best").over(Window.partitionBy(c)) for c in ("cash_id", "rada_id")]
        mutual = left.withColumns({"_c": of[0], "_r": of[1]}).filter("_best = _c and _best = _r").drop("_c", "_r")
        settled.append(mutual.checkpoint(eager=True))
        for c in ("cash_id", "rada_id"):
            left = left.join(settled[-1].select(c), c, "left_anti")
        left = left.checkpoint(eager=True)
    return reduce(DataFrame.unionByName, settled, left).drop("_best")


def field_breaks(classified: DataFrame, cash: DataFrame, rada: DataFrame, cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """One row per break (``BREAK_COLUMNS``) of a classification. ``classified`` is read more
    than once: pass stored or checkpointed rows. ``cash`` and ``rada`` are its ledgers."""
    def still_open(ledger: DataFrame, id_col: str, status: str) -> DataFrame:
        ids = classified.filter(F.col("recon_status") == status).select(id_col)
        return ledger.join(ids, id_col, "left_semi").select(id_col, *KEY_FIELDS, AMOUNT_FIELD)

    edges = candidates(still_open(cash, CASH.id_col, UNMATCHED), still_open(rada, RADA.id_col, NEW), cfg)
    by_amount = classified.filter(F.col("recon_status") == AMOUNT_MISMATCH).select(
        "cash_id", "rada_id", F.lit(AMOUNT_FIELD).alias("field"), exact(F.col("amount")).cast("string").alias("cash_value"),
        exact(F.col("rada_amount")).cast("string").alias("rada_value"), "amount", "rada_amount")
    return resolve(edges).select(*BREAK_COLUMNS).unionByName(by_amount)
