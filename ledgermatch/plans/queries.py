"""Named queries over the shared test tables: ``(spark, sf_dir) -> DataFrame``.

Each query runs the library's operators on ledgers derived from the whole
``orders`` (or ``lineitem``) table. Two run dates are used where history
matters: an earlier run (PREV) whose RADA extract lacked some records, and
the current run (RUN) a week later.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CASH, RADA, RESCUED, ReconConfig
from ..functions.keys import prepare_for_matching
from ..operators import gold as gold_ops
from ..operators import kpis, match, measures, quality
from ..operators.cleared import detect_cleared, snapshot_open_keys
from ..operators.field_breaks import field_breaks
from ..operators.standardise import latest_per_id, normalise, standardise, standardise_counts
from ..schemas import landing_schema, type_contract
from ..session import scratch_path
from ..sinks import catalog, tables
from ..sources import fixed_width
from ..sources import fixtures as fx
from ..streaming.evolving import ingest_evolving, read_bronze
from ..streaming.ingest import ingest, validate_schema
from ..streaming.silver import apply_batch
from . import steps

PREV_RUN_DATE, PREV_RUN_TS = "2026-01-01", "2026-01-01 01:00:00"
RUN_DATE, RUN_TS = "2026-01-08", "2026-01-08 01:00:00"
LATER_RUN_TS = "2026-01-08 05:30:00"
THIRD_RUN_DATE, THIRD_RUN_TS = "2026-01-15", "2026-01-15 01:00:00"
CFG = ReconConfig()

LEDGER_OUT = (CASH.id_col, "account_number", "trade_reference", "swift_bic", "transaction_date", "value_date",
              "settlement_date", "currency", "amount", "debit_credit", "narrative", "status")
GOLD_OUT = tuple(c for c in gold_ops.GOLD_COLUMNS if c != "_run_ts")


# --- shared building blocks ----------------------------------------------

def silver_cash(spark: SparkSession, sf: str) -> DataFrame:
    return standardise(fx.cash_bronze(spark, sf), CASH).clean


def silver_rada(spark: SparkSession, sf: str, *, earlier: bool = False) -> DataFrame:
    return standardise(fx.rada_bronze(spark, sf, earlier=earlier), RADA, amount_scale=CFG.rada_amount_scale).clean


def keyed_cash(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_for_matching(silver_cash(spark, sf), CASH.id_col)


def keyed_rada(spark: SparkSession, sf: str, *, earlier: bool = False) -> DataFrame:
    return prepare_for_matching(silver_rada(spark, sf, earlier=earlier), RADA.id_col)


def classified(spark: SparkSession, sf: str, *, earlier: bool = False,
               previous_open: DataFrame | None = None) -> DataFrame:
    return match.classify(keyed_cash(spark, sf), keyed_rada(spark, sf, earlier=earlier), CFG,
                          previous_open=previous_open)


def whole_cash(spark: SparkSession, sf: str) -> DataFrame:
    """Cash silver of every order."""
    return standardise(fx.cash_bronze(spark, sf, whole=True), CASH).clean


def whole_rada(spark: SparkSession, sf: str) -> DataFrame:
    """RADA silver of every order."""
    return standardise(fx.rada_bronze(spark, sf, whole=True), RADA, amount_scale=CFG.rada_amount_scale).clean


def previous_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows of the earlier run (its first run: nothing to clear)."""
    return gold_ops.assemble(classified(spark, sf, earlier=True), None, PREV_RUN_TS, PREV_RUN_DATE)


def stored_previous(spark: SparkSession, sf: str) -> str:
    """The earlier run, matched once and stored; its path."""
    path = scratch_path(spark, "gold")
    tables.overwrite_partitions(previous_gold(spark, sf), path, rebalance=False)
    return path


def next_gold(spark: SparkSession, sf: str, history: str, run_ts: str = RUN_TS, run_date: str = RUN_DATE) -> DataFrame:
    """A later run's gold rows, CLEARED against the stored history."""
    before = snapshot_open_keys(spark.read.parquet(history), run_date, CFG.lookback_days)
    return gold_ops.assemble(classified(spark, sf, previous_open=before), None, run_ts, run_date)


def current_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Today's gold rows."""
    return next_gold(spark, sf, stored_previous(spark, sf))


def stored_history(spark: SparkSession, sf: str) -> str:
    """Both runs, each matched once and stored in its run-date partition; the path."""
    path = stored_previous(spark, sf)
    tables.overwrite_partitions(next_gold(spark, sf, path), path, rebalance=False)
    return path


def gold_history(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(stored_history(spark, sf))


def dirty_cash(spark: SparkSession, sf: str):
    return standardise(fx.dirty_cash_bronze(spark, sf), CASH)


# --- silver --------------------------------------------------------------

def q_silver_clean(spark, sf):
    """Dirty cash extract standardised: valid rows, one per id."""
    return dirty_cash(spark, sf).clean.select(*LEDGER_OUT)


def q_silver_quarantine(spark, sf):
    """Dirty cash extract: every rejected row with its reason."""
    return dirty_cash(spark, sf).quarantine.select(*LEDGER_OUT, "_rejection_reason")


def q_silver_dedup(spark, sf):
    """Survivors of ids that arrived more than once among accepted rows."""
    std = dirty_cash(spark, sf)
    repeated = std.accepted.groupBy(CASH.id_col).count().filter(F.col("count") > 1).select(CASH.id_col)
    return latest_per_id(std.accepted.join(repeated, CASH.id_col, "left_semi"), CASH.id_col).select(*LEDGER_OUT)


def q_silver_counts(spark, sf):
    """Input, accepted, rejected and clean-id counts of the dirty extract."""
    return standardise_counts(fx.dirty_cash_bronze(spark, sf), CASH)


def q_silver_incremental(spark, sf):
    """Three landing days, the third with ids sent again, each upserted as it
    comes; the last day's rows are then applied a second time."""
    root = scratch_path(spark, "incremental")
    bronze, silver, quarantine = f"{root}/bronze", f"{root}/silver", f"{root}/quarantine"
    days = fx.dirty_cash_days(spark, sf)
    for day in days:
        day.write.mode("append").parquet(bronze)
        steps.standardise_increment(spark, CASH, bronze, silver, quarantine, f"{root}/checkpoint", CFG, buckets=16)
    apply_batch(days[-1], len(days) - 1, CASH, silver, quarantine, buckets=16, cfg=CFG)
    return spark.read.parquet(silver).select(*LEDGER_OUT)


# --- keys and matching ---------------------------------------------------

def q_keyed_cash(spark, sf):
    """Cash silver ledger with business keys, every order."""
    return prepare_for_matching(whole_cash(spark, sf), CASH.id_col)


def q_keyed_rada(spark, sf):
    """RADA silver ledger with business keys, every order."""
    return prepare_for_matching(whole_rada(spark, sf), RADA.id_col)


def q_recon_classified(spark, sf):
    """Every record of both ledgers, paired and labelled."""
    return classified(spark, sf)


INCREMENT_DAYS = ("2026-01-06", "2026-01-07", "2026-01-08")


def q_recon_incremental(spark, sf):
    """Both ledgers over three days, most pairs with their records on two of them:
    each day matches its new records with the open ones. All records after the third."""
    root = scratch_path(spark, "increment")
    number = F.regexp_extract(F.col("trade_reference"), "([0-9]+)$", 1).cast("long")
    for name, ledger, shift in (("cash", silver_cash(spark, sf), 0), ("rada", silver_rada(spark, sf), 1)):
        tables.overwrite(ledger.withColumn("_day", ((number + shift) % 3).cast("int")), f"{root}/{name}", ["_day"])
    for i, day in enumerate(INCREMENT_DAYS):
        new = [spark.read.parquet(f"{root}/{name}").filter(F.col("_day") == i) for name in ("cash", "rada")]
        steps.reconcile_increment(spark, *new, f"{root}/closed", f"{root}/open", day, CFG)
    return steps.incremental_classification(spark, f"{root}/closed", f"{root}/open", INCREMENT_DAYS[-1], CFG)


def q_recon_matched(spark, sf):
    """MATCHED pairs (13 columns)."""
    return match.matched(classified(spark, sf))


def q_recon_unmatched(spark, sf):
    """Cash records without a RADA partner (10 columns)."""
    return match.unmatched(classified(spark, sf))


def q_recon_new(spark, sf):
    """RADA records without a cash partner (4 columns)."""
    return match.new(classified(spark, sf))


def q_recon_amount_mismatch(spark, sf):
    """Pairs outside the tolerance (12 columns)."""
    return match.amount_mismatched(classified(spark, sf))


def q_recon_repeated_keys(spark, sf):
    """Matching where (order, line) keys repeat: pairs one-to-one by amount."""
    cash, rada = fx.repeated_key_ledgers(spark, sf)
    return match.classify(prepare_for_matching(cash, CASH.id_col), prepare_for_matching(rada, RADA.id_col), CFG)


def q_recon_skewed_keys(spark, sf):
    """Matching where each of three keys holds a third of all rows."""
    cash, rada = fx.repeated_key_ledgers(spark, sf, skewed=True)
    return match.classify(prepare_for_matching(cash, CASH.id_col), prepare_for_matching(rada, RADA.id_col), CFG)


def q_recon_field_breaks(spark, sf):
    """Which field keeps open records apart, with both values."""
    rada = standardise(fx.rada_field_faults(spark, sf), RADA, amount_scale=CFG.rada_amount_scale).clean
    path = scratch_path(spark, "breaks")
    for name, ledger in (("cash", silver_cash(spark, sf)), ("rada", rada)):
        tables.overwrite(ledger, f"{path}/{name}")
    cash, rada = (spark.read.parquet(f"{path}/{name}") for name in ("cash", "rada"))
    tables.overwrite(match.classify(prepare_for_matching(cash, CASH.id_col), prepare_for_matching(rada, RADA.id_col), CFG),
                     f"{path}/classified")
    return field_breaks(spark.read.parquet(f"{path}/classified"), cash, rada, CFG)


def q_recon_cleared(spark, sf):
    """Keys open in the earlier run's snapshot and not open today (standalone form)."""
    history = spark.read.parquet(stored_previous(spark, sf))
    cleared, _ = detect_cleared(classified(spark, sf), history, RUN_DATE, CFG)
    return cleared


def q_recon_cleared_three_runs(spark, sf):
    """Three weekly runs: keys open in the first and closed in the second are
    CLEARED by the second alone. The CLEARED rows of all runs."""
    path = stored_history(spark, sf)
    tables.overwrite_partitions(next_gold(spark, sf, path, THIRD_RUN_TS, THIRD_RUN_DATE), path, rebalance=False)
    return (spark.read.parquet(path).filter(F.col("recon_status") == "CLEARED")
            .select("_run_date", "business_key"))


def q_open_item_ageing(spark, sf):
    """Open keys of the third weekly run: since when, over how many runs in a row, and the
    age class, carried forward run by run."""
    path = stored_history(spark, sf)
    tables.overwrite_partitions(next_gold(spark, sf, path, THIRD_RUN_TS, THIRD_RUN_DATE), path, rebalance=False)
    aged = scratch_path(spark, "ageing")
    for day in (PREV_RUN_DATE, RUN_DATE, THIRD_RUN_DATE):
        steps.age_open_items(spark, path, aged, day)
    return spark.read.parquet(aged).filter(F.col("_run_date") == F.lit(THIRD_RUN_DATE).cast("date")).drop("_run_date")


def q_recon_still_unmatched(spark, sf):
    """Today's unmatched rows without the cleared keys."""
    history = spark.read.parquet(stored_previous(spark, sf))
    _, unmatched, _, _ = match.reconcile(keyed_cash(spark, sf), keyed_rada(spark, sf), CFG)
    _, still = detect_cleared(unmatched, history, RUN_DATE, CFG)
    return still.select(*match.UNMATCHED_COLUMNS)


# --- gold ----------------------------------------------------------------

def q_gold_union(spark, sf):
    """The per-class workflow: four class frames from one (materialised)
    match, CLEARED from the unmatched frame, unioned by name and stamped."""
    m, u, n, mm = match.reconcile(keyed_cash(spark, sf), keyed_rada(spark, sf), CFG)
    cleared, still = detect_cleared(u, spark.read.parquet(stored_previous(spark, sf)), RUN_DATE, CFG)
    rows = gold_ops.union_results(m, still.select(*match.UNMATCHED_COLUMNS), n, cleared, mm)
    return rows.withColumns(gold_ops.run_stamps(RUN_TS, RUN_DATE)).select(*GOLD_OUT)


def q_gold_upsert(spark, sf):
    """Target: the earlier run plus a first attempt of today's run made with
    the earlier RADA extract; source: today's final rows."""
    history = stored_previous(spark, sf)
    prev = spark.read.parquet(history)
    first_attempt = prev.drop("_run_ts", "_run_date").withColumns(gold_ops.run_stamps(RUN_TS, RUN_DATE))
    source = scratch_path(spark, "source")
    tables.overwrite(next_gold(spark, sf, history), source)  # read for its keys and for its rows
    return gold_ops.replace_groups(prev.unionByName(first_attempt), spark.read.parquet(source)).select(*GOLD_OUT)


def gold_day(spark, sf):
    return kpis.for_run_date(gold_history(spark, sf), RUN_DATE)


# --- KPIs and reports ----------------------------------------------------

def q_status_counts(spark, sf):
    """Records per status for today's run (every status listed)."""
    return kpis.status_counts(gold_day(spark, sf))


def q_kpi_daily(spark, sf):
    """Today's KPI row."""
    return kpis.kpi_daily(gold_history(spark, sf), RUN_DATE)


def q_kpi_currency_breakdown(spark, sf):
    """Count and amount per (currency, status) for today's run."""
    return kpis.currency_breakdown(gold_day(spark, sf), RUN_DATE)


def q_kpi_trend(spark, sf):
    """One KPI row per run date."""
    return kpis.kpi_trend(gold_history(spark, sf))


def q_run_summary(spark, sf):
    """Step counts of the run: input, accepted, rejected, clean, and per status."""
    counts = standardise_counts(fx.cash_bronze(spark, sf), CASH)
    steps = counts.select(*[F.col(c).alias(f"cash_{c}") for c in counts.columns])
    rada_counts = standardise_counts(fx.rada_bronze(spark, sf), RADA)
    rada_steps = rada_counts.select(*[F.col(c).alias(f"rada_{c}") for c in rada_counts.columns])
    status = kpis.status_counts(gold_day(spark, sf)).select(F.lower("recon_status").alias("step"), "records")
    return (kpis.run_summary(steps).unionByName(kpis.run_summary(rada_steps))
            .unionByName(status.withColumnRenamed("records", "rows")))


def q_report_exposure_by_currency(spark, sf):
    """Open amount and record count per currency, largest first."""
    return kpis.exposure_by_currency(gold_day(spark, sf))


def q_report_top_mismatch(spark, sf):
    """The 50 largest breaks by absolute variance."""
    return kpis.top_mismatches(gold_day(spark, sf), 50)


# --- data quality ------------------------------------------------------------

BRONZE_CASH = "bronze.cash_transactions"


def typed_dirty(spark, sf):
    """The dirty extract typed and normalised but not yet filtered."""
    return normalise(fx.dirty_cash_bronze(spark, sf), CASH).drop("_mandatory_ok")


def q_dq_completeness(spark, sf):
    """Completeness check on the typed dirty extract."""
    return quality.check_completeness(typed_dirty(spark, sf), BRONZE_CASH, CASH.required_cols,
                                      CFG.completeness_threshold)


def q_dq_duplicate_rate(spark, sf):
    """Duplicate-rate check on the typed dirty extract."""
    return quality.check_duplicates(typed_dirty(spark, sf), BRONZE_CASH, CASH.id_col, CFG.duplicate_threshold)


def q_dq_negative_amounts(spark, sf):
    """Negative-amount check on the typed dirty extract."""
    return quality.check_negative_amounts(typed_dirty(spark, sf), BRONZE_CASH)


def q_dq_schema(spark, sf):
    """Type contract against the raw (text-typed) extract: dates and amount are text there."""
    return quality.check_schema(fx.dirty_cash_bronze(spark, sf), BRONZE_CASH, type_contract(CASH))


def q_dq_suite(spark, sf):
    """All checks for the typed dirty cash extract and the RADA silver ledger."""
    return quality.run_suite([(typed_dirty(spark, sf), BRONZE_CASH, CASH),
                              (whole_rada(spark, sf), "silver.rada_transactions", RADA)], CFG)


# --- measures --------------------------------------------------------------

def q_measure_matched_rate(spark, sf):
    """Dashboard matched rate over the KPI rows of both runs."""
    return measures.matched_rate(kpis.kpi_trend(gold_history(spark, sf)))


def q_measure_exception_flag(spark, sf):
    """Today's exception rows with their exception flag."""
    return measures.with_exception_flag(measures.exceptions(gold_day(spark, sf)))


def q_measure_total_variance(spark, sf):
    """Total cash minus total RADA over the silver ledgers."""
    return measures.total_variance(whole_cash(spark, sf), whole_rada(spark, sf))


# --- IO round trips (written under the session's checkpoint folder) ------

def q_validate_schema(spark, sf):
    """Post-ingest mandatory-column check of the cash extract."""
    return validate_schema(fx.cash_bronze(spark, sf, whole=True), BRONZE_CASH, CASH)


def q_validate_schema_rada(spark, sf):
    """Post-ingest mandatory-column check of the RADA extract."""
    return validate_schema(fx.rada_bronze(spark, sf, whole=True), "bronze.rada_transactions", RADA)


def q_silver_by_name(spark, sf):
    """Cash silver stored, registered in the catalog and read by its name."""
    path = scratch_path(spark, "silver")
    tables.overwrite(whole_cash(spark, sf), path)
    name = catalog.register(spark, [("silver", f"cash_{path.rsplit('-', 1)[1]}", path)], prefix="lm_")[0]
    return tables.read(spark, name).select(*LEDGER_OUT)


def q_silver_stamped(spark, sf):
    """Each cash id with the stamp of the run that standardised it."""
    stamped = standardise(fx.cash_bronze(spark, sf, whole=True), CASH, standardised_ts=F.lit(RUN_TS).cast("timestamp"))
    return stamped.clean.select(CASH.id_col, "_standardised_ts")


def q_quarantine_stored(spark, sf):
    """The stored quarantine: after two runs over the dirty extract (each
    reject once), and after a dirty and then a clean extract (nothing left)."""
    root = scratch_path(spark, "quarantine")
    batch = F.lit(RUN_DATE).cast("date")
    dirty, clean = f"{root}/bronze_dirty", f"{root}/bronze_clean"
    tables.overwrite(fx.dirty_cash_bronze(spark, sf).withColumn("_batch_date", batch), dirty)
    tables.overwrite(fx.cash_bronze(spark, sf, whole=True).withColumn("_batch_date", batch), clean)
    for case, second in (("twice", dirty), ("then_clean", clean)):
        for bronze in (dirty, second):
            steps.standardise_ledger(spark, CASH, bronze, f"{root}/{case}/silver", f"{root}/{case}/quarantine",
                                     RUN_DATE, RUN_TS, CFG)
    left = [df.withColumn("runs", F.lit(case)) for case in ("twice", "then_clean")
            if (df := tables.read_if_exists(spark, f"{root}/{case}/quarantine")) is not None]
    return reduce(DataFrame.unionByName, left).select("runs", *LEDGER_OUT, "_rejection_reason", "_batch_date")


def q_dq_stored(spark, sf):
    """The stored results of the check suite over both silver ledgers."""
    root = scratch_path(spark, "dq")
    tables.overwrite(whole_cash(spark, sf), f"{root}/cash")
    tables.overwrite(whole_rada(spark, sf), f"{root}/rada")
    steps.run_dq_suite(spark, [(f"{root}/cash", CASH), (f"{root}/rada", RADA)], f"{root}/results", RUN_DATE, RUN_TS, CFG,
                       fail_on_error=False)
    return spark.read.parquet(f"{root}/results").withColumn("table", F.element_at(F.split("table", "/"), -1))


def q_kpi_breakdown_stored(spark, sf):
    """The stored currency breakdown of today's run."""
    root = scratch_path(spark, "kpis")
    steps.compute_kpis(spark, stored_history(spark, sf), f"{root}/kpis", f"{root}/breakdown", RUN_DATE)
    return spark.read.parquet(f"{root}/breakdown")


def q_run_audit(spark, sf):
    """The stored audit of two attempts at one run date."""
    path = scratch_path(spark, "audit")
    counts = standardise_counts(fx.dirty_cash_bronze(spark, sf), CASH).first().asDict()
    for run_ts in (RUN_TS, LATER_RUN_TS):
        steps.record_run(spark, path, RUN_DATE, run_ts, counts)
    return spark.read.parquet(path).drop("_run_date", "_attempt")


def q_ingest_lineage(spark, sf):
    """Two landing days ingested one after the other: where each row came
    from, and whether its lineage stamps agree."""
    root = scratch_path(spark, "lineage")
    extract = fx.cash_bronze(spark, sf, whole=True).drop("_ingested_ts")
    second = F.substring(CASH.id_col, -1, 1).isin("1", "3", "5", "7", "9")
    bronze = f"{root}/bronze"
    total = 0
    for day, rows in (("day1", extract.filter(~second)), ("day2", extract.filter(second))):
        tables.write_csv(rows, f"{root}/landing/{day}")
        result = ingest(spark, f"{root}/landing/*", bronze, f"{root}/checkpoint", CASH)
        total += result.new_rows
        if result.total_rows != total:
            raise RuntimeError(f"ingest counts do not add up: {result}")
    return spark.read.parquet(bronze).select(
        CASH.id_col, F.regexp_extract("_source_file", "/landing/([^/]+)/", 1).alias("batch"),
        (F.col("_batch_date") == F.col("_ingested_ts").cast("date")).alias("same_day"))


def q_ingest_counts(spark, sf):
    """Rows per landing day as the ingest counted them, against the stored rows."""
    return q_ingest_lineage(spark, sf).groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))

def q_ingest_stream(spark, sf):
    """Land the cash extract as CSV files, stream-ingest it twice (the second
    run finds nothing new), return the bronze rows without lineage columns."""
    root = scratch_path(spark, "ingest")
    landing, bronze, ckpt = f"{root}/landing/cash", f"{root}/bronze/cash", f"{root}/checkpoints/cash"
    extract = fx.cash_bronze(spark, sf, whole=True).drop("_ingested_ts")
    tables.write_csv(extract, landing)
    first = ingest(spark, landing, bronze, ckpt, CASH)
    again = ingest(spark, landing, bronze, ckpt, CASH)
    if again.new_rows != 0 or again.total_rows != first.total_rows:
        raise RuntimeError(f"re-ingest was not idempotent: {first} then {again}")
    return spark.read.parquet(bronze).select(*[f.name for f in landing_schema(CASH).fields])


def evolved_bronze(spark, sf):
    """Bronze after three landing days with a new column and reordered headers, ingested day by day."""
    root = scratch_path(spark, "evolving")
    bronze, schema = f"{root}/bronze", f"{root}/schema"
    for day, rows in enumerate(fx.evolving_cash_days(spark, sf), 1):
        tables.write_csv(rows, f"{root}/landing/day{day}")
        ingest_evolving(spark, f"{root}/landing/*", bronze, f"{root}/checkpoint", schema, CASH)
    return read_bronze(spark, bronze, schema)


def q_ingest_evolving(spark, sf):
    """Every landed row of the three days, with the column that came on the second."""
    return evolved_bronze(spark, sf).select(*[f.name for f in landing_schema(CASH).fields], "channel",
                                            F.regexp_extract("_source_file", "/landing/([^/]+)/", 1).alias("day"))


def q_quarantine_rescued(spark, sf):
    """Rejected rows of the three days, with the landing lines that did not fit."""
    return standardise(evolved_bronze(spark, sf), CASH).quarantine.select(
        CASH.id_col, "amount", "_rejection_reason", F.col(RESCUED).alias("rescued_line"))


def q_ingest_rada_fixed_width(spark, sf):
    """RADA delivered as fixed-width text with amounts in cents: land it,
    stream-ingest it, standardise with the minor-unit scale; the result must
    equal the RADA silver ledger built from the delimited extract."""
    root = scratch_path(spark, "ingest-fw")
    landing, bronze, ckpt = f"{root}/landing/rada", f"{root}/bronze/rada", f"{root}/checkpoints/rada"
    layout = fixed_width.ledger_layout(RADA)
    fixed_width.render(fx.rada_minor_units(spark, sf), layout).write.mode("overwrite").text(landing)
    ingest(spark, landing, bronze, ckpt, RADA, fixed_width=layout)
    std = standardise(spark.read.parquet(bronze), RADA, amount_scale=100.0)
    return std.clean.select(RADA.id_col, *LEDGER_OUT[1:])


def q_daily_run_kpis(spark, sf):
    """Two full cycles from landing files: the earlier day with the early
    RADA extract, then today after the late RADA records land. Returns the
    stored KPI table."""
    from .daily_run import Layout, run_daily

    root = scratch_path(spark, "daily")
    layout = Layout(f"{root}/lake")
    cash_landing, rada_landing = f"{root}/landing/cash", f"{root}/landing/rada"
    early = fx.rada_bronze(spark, sf, earlier=True).drop("_ingested_ts")
    late = fx.rada_bronze(spark, sf).drop("_ingested_ts").join(early.select(RADA.id_col), RADA.id_col, "left_anti")
    tables.write_csv(fx.cash_bronze(spark, sf).drop("_ingested_ts"), f"{cash_landing}/day1")
    tables.write_csv(early, f"{rada_landing}/day1")
    run_daily(spark, layout, cash_landing=f"{cash_landing}/*", rada_landing=f"{rada_landing}/*",
              run_date=PREV_RUN_DATE, run_ts=PREV_RUN_TS, cfg=CFG)
    tables.write_csv(late, f"{rada_landing}/day8")
    run_daily(spark, layout, cash_landing=f"{cash_landing}/*", rada_landing=f"{rada_landing}/*",
              run_date=RUN_DATE, run_ts=RUN_TS, cfg=CFG)
    return spark.read.parquet(layout.kpis).select(*kpis.KPI_COLUMNS)


def q_gold_clustered(spark, sf):
    """Today's gold rows written sorted, rewritten range-clustered, read back."""
    path = scratch_path(spark, "gold")
    tables.upsert_gold(spark, current_gold(spark, sf), path, [RUN_DATE], cluster_by=CFG.gold_cluster_cols)
    tables.optimize_layout(spark, path, [RUN_DATE], CFG.gold_cluster_cols)
    return spark.read.parquet(path).select(*GOLD_OUT)


def q_gold_z_ordered(spark, sf):
    """Today's gold rows rewritten in Z-order of the BI filter columns, read back."""
    path = scratch_path(spark, "gold")
    tables.upsert_gold(spark, current_gold(spark, sf), path, [RUN_DATE])
    tables.optimize_layout(spark, path, [RUN_DATE], CFG.gold_cluster_cols, z_order=True)
    return spark.read.parquet(path).select(*GOLD_OUT)


def q_export_kpi(spark, sf):
    """Today's KPI row through a CSV export and back."""
    path = scratch_path(spark, "export-kpi")
    kpi = q_kpi_daily(spark, sf)
    tables.write_csv(kpi, path)
    return tables.read_csv(spark, path, kpi.schema)


def q_export_exceptions(spark, sf):
    """Today's exception rows through a CSV export and back."""
    path = scratch_path(spark, "export-exceptions")
    rows = measures.exceptions(gold_day(spark, sf))
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_clean": q_silver_clean,
    "silver_quarantine": q_silver_quarantine,
    "silver_dedup": q_silver_dedup,
    "silver_counts": q_silver_counts,
    "keyed_cash": q_keyed_cash,
    "keyed_rada": q_keyed_rada,
    "recon_classified": q_recon_classified,
    "recon_matched": q_recon_matched,
    "recon_unmatched": q_recon_unmatched,
    "recon_new": q_recon_new,
    "recon_amount_mismatch": q_recon_amount_mismatch,
    "recon_repeated_keys": q_recon_repeated_keys,
    "recon_skewed_keys": q_recon_skewed_keys,
    "recon_field_breaks": q_recon_field_breaks,
    "open_item_ageing": q_open_item_ageing,
    "recon_incremental": q_recon_incremental,
    "silver_incremental": q_silver_incremental,
    "recon_cleared": q_recon_cleared,
    "recon_cleared_three_runs": q_recon_cleared_three_runs,
    "recon_still_unmatched": q_recon_still_unmatched,
    "gold_union": q_gold_union,
    "gold_upsert": q_gold_upsert,
    "status_counts": q_status_counts,
    "kpi_daily": q_kpi_daily,
    "kpi_currency_breakdown": q_kpi_currency_breakdown,
    "kpi_trend": q_kpi_trend,
    "run_summary": q_run_summary,
    "report_exposure_by_currency": q_report_exposure_by_currency,
    "report_top_mismatch": q_report_top_mismatch,
    "dq_completeness": q_dq_completeness,
    "dq_duplicate_rate": q_dq_duplicate_rate,
    "dq_negative_amounts": q_dq_negative_amounts,
    "dq_schema": q_dq_schema,
    "dq_suite": q_dq_suite,
    "measure_matched_rate": q_measure_matched_rate,
    "measure_exception_flag": q_measure_exception_flag,
    "measure_total_variance": q_measure_total_variance,
    "validate_schema": q_validate_schema,
    "validate_schema_rada": q_validate_schema_rada,
    "silver_by_name": q_silver_by_name,
    "silver_stamped": q_silver_stamped,
    "quarantine_stored": q_quarantine_stored,
    "dq_stored": q_dq_stored,
    "kpi_breakdown_stored": q_kpi_breakdown_stored,
    "run_audit": q_run_audit,
    "ingest_lineage": q_ingest_lineage,
    "ingest_counts": q_ingest_counts,
    "ingest_stream": q_ingest_stream,
    "ingest_evolving": q_ingest_evolving,
    "quarantine_rescued": q_quarantine_rescued,
    "ingest_rada_fixed_width": q_ingest_rada_fixed_width,
    "gold_clustered": q_gold_clustered,
    "gold_z_ordered": q_gold_z_ordered,
    "daily_run_kpis": q_daily_run_kpis,
    "export_kpi": q_export_kpi,
    "export_exceptions": q_export_exceptions,
}
