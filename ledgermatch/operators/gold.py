"""Gold rows: the union of all classes with run stamps, and the upsert rule."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .match import RESULT_COLUMNS, reason_expr

GOLD_COLUMNS = RESULT_COLUMNS + ("_run_ts", "_run_date")
GOLD_KEY = ("business_key", "_run_date")


def run_stamps(run_ts: str | dt.datetime, run_date: str | dt.date) -> dict[str, Column]:
    return {"_run_ts": F.lit(str(run_ts)).cast("timestamp"), "_run_date": F.lit(str(run_date)).cast("date")}


def union_results(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a frame is NULL there."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if "mismatch_reason" not in merged.columns:
        merged = merged.withColumn("mismatch_reason", reason_expr(F.col("recon_status")))
    cols = [c for c in RESULT_COLUMNS if c in merged.columns]
    extra = [c for c in merged.columns if c not in cols]
    return merged.select(*cols, *extra)


def assemble(classified: DataFrame, cleared: DataFrame | None, run_ts: str | dt.datetime,
             run_date: str | dt.date) -> DataFrame:
    """Today's gold rows: every classified row plus one row per cleared key.

    The classified rows already carry today's UNMATCHED set; cleared keys are
    by construction absent from it, so no row has to be removed. Pass
    ``cleared=None`` when the classification already holds its CLEARED rows.
    """
    rows = classified if cleared is None else union_results(classified, cleared)
    return rows.withColumns(run_stamps(run_ts, run_date)).select(*GOLD_COLUMNS)


def replace_groups(target: DataFrame, source: DataFrame, keys=GOLD_KEY) -> DataFrame:
    """Upsert by group replacement: every (business_key, _run_date) present in
    ``source`` is replaced by the source rows; other target rows stay.

    Equal to a MERGE update-all/insert-all when keys are unique, and defined
    (and idempotent) when a key has several rows. The anti join's right side
    is a distinct key set, so repeated keys only enlarge the streamed side. Target rows of
    run dates that ``source`` does not have (looked up when this is called) stay without a join.
    """
    others = None
    if "_run_date" in keys:
        dates = [r[0] for r in source.select("_run_date").distinct().collect() if r[0] is not None]
        same = F.coalesce(F.col("_run_date").isin(dates), F.lit(False))
        others, target = target.filter(~same), target.filter(same)
    src_keys = source.select(*keys).distinct()
    kept = target.join(src_keys, list(keys), "left_anti")
    if others is not None:
        kept = others.unionByName(kept)
    return kept.unionByName(source.select(*target.columns))
