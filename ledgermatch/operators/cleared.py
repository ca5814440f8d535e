"""CLEARED detection against an earlier gold snapshot.

A key is CLEARED when it was UNMATCHED in the snapshot - the latest run whose
run date lies before the run date less ``lookback_days`` - and is not UNMATCHED
today. Only that one run-date partition is read, so a key that was closed by
then is not cleared again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLEARED, MATCHED, UNMATCHED, ReconConfig


def snapshot_run_date(gold: DataFrame, run_date: str | dt.date, lookback_days: int) -> dt.date | None:
    """The latest stored run date before (run date - lookback); None if there
    is none. Reads the partition column only."""
    day = F.date_sub(F.lit(str(run_date)).cast("date"), int(lookback_days))
    return gold.filter(F.col("_run_date") < day).agg(F.max("_run_date")).first()[0]


def snapshot_open_keys(gold: DataFrame, run_date: str | dt.date, lookback_days: int) -> DataFrame:
    """Business keys of the UNMATCHED rows of the snapshot run (a key repeats
    for each of its records). Pass a stored table: the run date is looked up
    when this is called, and the returned frame reads that partition alone."""
    day = snapshot_run_date(gold, run_date, lookback_days)
    if day is None:
        return gold.filter(F.lit(False)).select("business_key")
    return gold.filter((F.col("_run_date") == F.lit(day)) & (F.col("recon_status") == UNMATCHED)).select("business_key")


def previous_unmatched_keys(gold: DataFrame, run_date: str | dt.date, lookback_days: int) -> DataFrame:
    """Distinct keys UNMATCHED in the snapshot."""
    return snapshot_open_keys(gold, run_date, lookback_days).distinct()


def cleared_keys(current: DataFrame, gold: DataFrame, run_date: str | dt.date,
                 cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """Keys cleared since the snapshot. ``current`` is today's classification.

    Both sides of the anti join are distinct key sets, so a key repeated
    across many rows or run dates cannot skew it.
    """
    prev = previous_unmatched_keys(gold, run_date, cfg.lookback_days)
    still_open = current.filter(F.col("recon_status") == UNMATCHED).select("business_key").distinct()
    keys = prev.join(still_open, "business_key", "left_anti")
    if cfg.cleared_requires_match:
        now_matched = current.filter(F.col("recon_status") == MATCHED).select("business_key").distinct()
        keys = keys.join(now_matched, "business_key", "left_semi")
    return keys


def detect_cleared(current: DataFrame, gold: DataFrame | None, run_date: str | dt.date,
                   cfg: ReconConfig = ReconConfig()) -> tuple[DataFrame, DataFrame]:
    """``(cleared, still_unmatched)``.

    ``gold=None`` means no gold table exists yet (first run): nothing is
    cleared and every unmatched row stays open. ``still_unmatched`` removes
    cleared keys from today's unmatched rows; by construction no cleared key
    is unmatched today, so it equals today's unmatched rows.

    This standalone form reads today's classification twice (rows and keys);
    ``match.classify(..., previous_open=snapshot_open_keys(...))`` computes
    the same CLEARED rows inside the single matching pass.
    """
    open_rows = current.filter(F.col("recon_status") == UNMATCHED)
    if gold is None:
        # an empty frame the optimizer can see is empty, so unions drop it
        empty = current.select("business_key", F.lit(CLEARED).alias("recon_status")).filter(F.lit(False))
        return empty, open_rows
    keys = cleared_keys(current, gold, run_date, cfg)
    cleared = keys.withColumn("recon_status", F.lit(CLEARED))
    still = open_rows.join(keys, "business_key", "left_anti")
    return cleared, still
