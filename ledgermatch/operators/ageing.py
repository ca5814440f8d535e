"""Ageing of open items: since when, and over how many runs in a row, a key is open.

A key is open in a run when it has an UNMATCHED, NEW or AMOUNT_MISMATCH record there.
``carry_forward`` extends the ageing of the run before by one run and reads nothing
older; ``from_history`` works out the same from all stored runs at once (gaps and
islands: in consecutive runs the run's number less the key's own count of open runs
stays the same). A key that was not open in the run before starts anew.

Both sides of the carry are unique per key, so no key is hot; several open records of a
key are counted map-side.

Defined results: a null key is a key; no stored run gives no row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AMOUNT_MISMATCH, NEW, UNMATCHED

OPEN_STATUSES = (UNMATCHED, NEW, AMOUNT_MISMATCH)
#: least days open of each age class, oldest first
AGE_CLASSES = ((30, "30 days and more"), (14, "14 to 29 days"), (7, "7 to 13 days"), (0, "under 7 days"))
AGEING_COLUMNS = ("business_key", "open_records", "first_open", "runs_open", "days_open", "age_class")


def open_keys(gold: DataFrame, *also: str) -> DataFrame:
    """(business_key, open_records) of gold rows; per ``also`` columns too."""
    return (gold.filter(F.col("recon_status").isin(*OPEN_STATUSES)).groupBy("business_key", *also)
            .agg(F.count(F.lit(1)).alias("open_records")))


def _aged(rows: DataFrame, day: Column) -> DataFrame:
    days = F.date_diff(day, F.col("first_open"))
    label: Column = F.lit(None).cast("string")
    for least, name in reversed(AGE_CLASSES):
        label = F.when(days >= least, F.lit(name)).otherwise(label)
    return rows.withColumns({"days_open": days, "age_class": label}).select(*AGEING_COLUMNS)


def carry_forward(previous: DataFrame | None, gold_day: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Ageing of a run from its gold rows and the ageing of the run before (None: the first run)."""
    day, today = F.lit(str(run_date)).cast("date"), open_keys(gold_day)
    if previous is None:
        return _aged(today.withColumns({"first_open": day, "runs_open": F.lit(1).cast("long")}), day)
    before = previous.select(F.col("business_key").alias("_key"), "first_open", "runs_open")
    joined = today.join(before, today["business_key"].eqNullSafe(before["_key"]), "left")
    return _aged(joined.withColumns({"first_open": F.coalesce("first_open", day),
                                     "runs_open": F.coalesce("runs_open", F.lit(0)) + F.lit(1).cast("long")}), day)


def from_history(gold: DataFrame) -> DataFrame:
    """Ageing of the last stored run, from the open keys of all runs."""
    runs = gold.select("_run_date").distinct()
    numbered = runs.withColumn("_run", F.row_number().over(Window.orderBy("_run_date")))  # one row per run
    own = Window.partitionBy("business_key").orderBy("_run")
    islands = (open_keys(gold, "_run_date").join(numbered, "_run_date")
               .withColumn("_island", F.col("_run") - F.row_number().over(own)))
    last = numbered.agg(F.max("_run").alias("_last"), F.max("_run_date").alias("_day"))
    spans = islands.groupBy("business_key", "_island").agg(
        F.min("_run_date").alias("first_open"), F.count(F.lit(1)).alias("runs_open"), F.max("_run").alias("_to"),
        F.max_by("open_records", "_run").alias("open_records"))
    return _aged(spans.join(last, F.col("_to") == F.col("_last")), F.col("_day"))
