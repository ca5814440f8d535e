"""The reconciliation cycle as separate steps over stored datasets.

Each step reads its inputs from storage and writes its outputs, so steps can
run as separate jobs (one task per step in a scheduler) and hand over only
through tables. ``daily_run.run_daily`` chains them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CASH, RADA, Ledger, ReconConfig
from ..functions.keys import prepare_for_matching
from ..operators import gold as gold_ops
from ..operators import ageing, kpis, quality
from ..operators.cleared import detect_cleared, snapshot_open_keys
from ..operators.match import classify, label_open, match_open
from ..operators.standardise import standardise
from ..session import checkpoint_root
from ..session import stored as kept
from ..sinks import tables
from ..streaming.ingest import IngestResult, ingest, validate_schema
from ..streaming.silver import standardise_new


def _day(run_date: str | dt.date):
    return F.lit(str(run_date)).cast("date")


def _stamp(df: DataFrame, run_date: str | dt.date) -> DataFrame:
    return df.withColumn("_run_date", _day(run_date))


def ingest_ledger(spark: SparkSession, ledger: Ledger, source_path: str, bronze_path: str, checkpoint_path: str,
                  **options) -> IngestResult:
    """Append new landing files to bronze (exactly once). Options as for
    ``streaming.ingest.ingest`` (``sep``, ``fixed_width``, ``amount_as_text``)."""
    return ingest(spark, source_path, bronze_path, checkpoint_path, ledger, **options)


def validate_bronze(spark: SparkSession, ledger: Ledger, bronze_path: str) -> dict:
    """Mandatory columns present, with the row count (one small job)."""
    return validate_schema(tables.read(spark, bronze_path), bronze_path, ledger).first().asDict()


def standardise_ledger(spark: SparkSession, ledger: Ledger, bronze_path: str, silver_path: str,
                       quarantine_path: str, run_date: str | dt.date, run_ts: str,
                       cfg: ReconConfig = ReconConfig()) -> dict:
    """Rebuild silver and quarantine from all of bronze.

    A reject is stored once, in the partition of the batch that brought it
    (``_batch_date``; the run date where bronze has none). Returns the clean
    count and the number of stored rejects.
    """
    scale = cfg.rada_amount_scale if ledger == RADA else 1.0
    bronze = tables.read(spark, bronze_path)
    if "_batch_date" not in bronze.columns:
        bronze = bronze.withColumn("_batch_date", _day(run_date))
    std = standardise(bronze, ledger, amount_scale=scale,
                      standardised_ts=F.lit(run_ts).cast("timestamp"))
    # silver is counted while it is written (no extra pass)
    clean_obs = Observation(f"{ledger.name}_clean")
    tables.overwrite(std.clean.observe(clean_obs, F.count(F.lit(1)).alias("rows")), silver_path)
    tables.overwrite(std.quarantine.hint("rebalance", "_batch_date"), quarantine_path, ["_batch_date"])
    stored = tables.read_if_exists(spark, quarantine_path)
    rejected = 0 if stored is None else stored.count()
    return {"silver_table": silver_path, "clean_count": int(clean_obs.get["rows"]), "quarantine_count": rejected}


def standardise_increment(spark: SparkSession, ledger: Ledger, bronze_path: str, silver_path: str, quarantine_path: str,
                          checkpoint_path: str, cfg: ReconConfig = ReconConfig(), **options) -> None:
    """Upsert the bronze files that came since the last run into silver (see ``streaming.silver``)."""
    standardise_new(spark, ledger, bronze_path, silver_path, quarantine_path, checkpoint_path, cfg=cfg, **options)


def latest_before(spark: SparkSession, path: str, run_date: str | dt.date) -> DataFrame | None:
    """What the last run before ``run_date`` stored: one partition."""
    stored = tables.read_if_exists(spark, path)
    if stored is None:
        return None
    day = stored.filter(F.col("_run_date") < _day(run_date)).agg(F.max("_run_date")).first()[0]
    return None if day is None else stored.filter(F.col("_run_date") == F.lit(day)).drop("_run_date")


def reconcile_increment(spark: SparkSession, cash_new: DataFrame, rada_new: DataFrame, closed_path: str, open_path: str,
                        run_date: str | dt.date, cfg: ReconConfig = ReconConfig()) -> None:
    """Match a day's new silver records with what is still open; store the day's
    closed pairs and the open pairs. Reads the new records and one partition of open
    pairs, never the closed ones; running a day again replaces its partitions."""
    keyed = (prepare_for_matching(cash_new, CASH.id_col), prepare_for_matching(rada_new, RADA.id_col))
    closed, still_open = match_open(*keyed, latest_before(spark, open_path, run_date), cfg)
    for rows, path in ((closed, closed_path), (still_open, open_path)):
        tables.overwrite_partitions(_stamp(rows, run_date), path, replace=[str(run_date)], rebalance=False)


def incremental_classification(spark: SparkSession, closed_path: str, open_path: str, run_date: str | dt.date,
                               cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """All records up to a run date: the pairs closed by then and what that run left open."""
    closed, left = (tables.read_if_exists(spark, path) for path in (closed_path, open_path))
    parts = []
    if closed is not None:  # a table without a row has no file yet
        parts.append(closed.filter(F.col("_run_date") <= _day(run_date)).drop("_run_date"))
    if left is not None:
        parts.append(label_open(left.filter(F.col("_run_date") == _day(run_date)).drop("_run_date"), cfg))
    if not parts:
        raise ValueError(f"no run is stored at {closed_path} and {open_path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def run_dq_suite(spark: SparkSession, tables_to_check: Sequence[tuple[str, Ledger]], results_path: str,
                 run_date: str | dt.date, run_ts: str, cfg: ReconConfig = ReconConfig(),
                 fail_on_error: bool = True) -> list[dict]:
    """All checks for each (silver path, ledger); results stored per run date,
    then the gate: raises ``DataQualityError`` when a check failed."""
    dq = quality.run_suite([(tables.read(spark, p), p, ledger) for p, ledger in tables_to_check], cfg)
    tables.overwrite_partitions(_stamp(dq.withColumn("run_ts", F.lit(run_ts).cast("timestamp")), run_date),
                                results_path)
    stored = spark.read.parquet(results_path).filter(F.col("_run_date") == _day(run_date)).drop("_run_date")
    return quality.gate(stored, fail_on_error=fail_on_error)


def reconcile_to_gold(spark: SparkSession, cash_silver: str, rada_silver: str, gold_path: str,
                      run_date: str | dt.date, run_ts: str, cfg: ReconConfig = ReconConfig()) -> None:
    """Key both ledgers, classify, detect CLEARED against the stored history,
    and upsert today's partition of gold."""
    cash_k = prepare_for_matching(tables.read(spark, cash_silver), CASH.id_col)
    rada_k = prepare_for_matching(tables.read(spark, rada_silver), RADA.id_col)
    history = tables.read_if_exists(spark, gold_path)
    if history is not None and not cfg.cleared_requires_match:
        # one pass: the snapshot's open keys ride along with the match
        current = classify(cash_k, rada_k, cfg, previous_open=snapshot_open_keys(history, run_date, cfg.lookback_days))
        rows = gold_ops.assemble(current, None, run_ts, run_date)
    else:
        current = classify(cash_k, rada_k, cfg)
        if history is not None:
            current = kept(current, "classified")  # read for its rows and for its keys
        cleared, _ = detect_cleared(current, history, run_date, cfg)
        rows = gold_ops.assemble(current, cleared, run_ts, run_date)
    tables.upsert_gold(spark, rows, gold_path, [str(run_date)], cluster_by=cfg.gold_cluster_cols)


def merge_to_gold(spark: SparkSession, frames: Sequence[DataFrame], gold_path: str, run_date: str | dt.date,
                  run_ts: str, cfg: ReconConfig = ReconConfig()) -> None:
    """Union result frames by name (e.g. matched, unmatched, new, cleared,
    mismatched), stamp them with the run and upsert them into gold."""
    rows = gold_ops.union_results(*frames).withColumns(gold_ops.run_stamps(run_ts, run_date))
    rows = rows.select(*[c for c in gold_ops.GOLD_COLUMNS if c in rows.columns])
    tables.upsert_gold(spark, rows, gold_path, [str(run_date)], cluster_by=cfg.gold_cluster_cols)


def optimize_gold(spark: SparkSession, gold_path: str, run_date: str | dt.date,
                  cfg: ReconConfig = ReconConfig()) -> None:
    """Maintenance: rewrite one stored run date in Z-order of the BI filter columns, so a
    filter on any of them skips whole files (run after the cycle)."""
    tables.optimize_layout(spark, gold_path, [str(run_date)], cfg.gold_cluster_cols, z_order=True)


def age_open_items(spark: SparkSession, gold_path: str, ageing_path: str, run_date: str | dt.date) -> None:
    """Ageing of a run's open keys, stored per run date, from its gold partition and
    the ageing of the run before. A run without open keys stores none, and the next starts anew."""
    gold = tables.read(spark, gold_path)
    runs = gold.filter(F.col("_run_date") < _day(run_date)).agg(F.max("_run_date")).first()[0]
    before = None if runs is None else tables.read_if_exists(spark, ageing_path)
    if before is not None:  # of the gold run just before: an older one would bridge a gap
        before = before.filter(F.col("_run_date") == F.lit(runs)).drop("_run_date")
    aged = ageing.carry_forward(before, kpis.for_run_date(gold, run_date), run_date)
    tables.overwrite_partitions(_stamp(aged, run_date), ageing_path, replace=[str(run_date)])


def compute_kpis(spark: SparkSession, gold_path: str, kpi_path: str, breakdown_path: str,
                 run_date: str | dt.date) -> dict:
    """KPI row and currency breakdown of one run date, stored per run date;
    returns the KPI row."""
    gold = tables.read(spark, gold_path)
    # one scan of the day's partition; the tiny summary (currencies x statuses
    # rows) is checkpointed and both outputs are written from it
    checkpoint_root(spark)
    summary = kpis.day_summary(kpis.for_run_date(gold, run_date)).checkpoint(eager=True)
    tables.overwrite_partitions(_stamp(kpis.kpi_from_summary(summary, run_date), run_date), kpi_path)
    tables.overwrite_partitions(kpis.breakdown_from_summary(summary, run_date), breakdown_path,
                                replace=[str(run_date)])
    row = spark.read.parquet(kpi_path).filter(F.col("_run_date") == _day(run_date)).drop("_run_date").first()
    return row.asDict()


def record_run(spark: SparkSession, audit_path: str, run_date: str | dt.date, run_ts: str,
               facts: Mapping[str, int | float]) -> None:
    """One audit row per attempt (run date and run time): what it read and
    produced. Counts are whole numbers. A repeated attempt at the same run time
    replaces its row; others stay."""
    names = sorted(facts)
    kinds = ", ".join(f"{n} {'double' if isinstance(facts[n], float) else 'bigint'}" for n in names)
    row = spark.createDataFrame([tuple(facts[n] for n in names)], kinds)
    stamp = F.lit(run_ts).cast("timestamp")
    audit = row.select(_day(run_date).alias("run_date"), stamp.alias("run_ts"), *names,
                       _day(run_date).alias("_run_date"), F.date_format(stamp, "yyyyMMddHHmmss").alias("_attempt"))
    (audit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_run_date", "_attempt").parquet(audit_path))
