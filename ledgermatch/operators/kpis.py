"""KPIs, breakdowns and operational reports over gold rows.

Each output is one aggregate pass (partial aggregation per task, a small
final merge); nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AMOUNT_MISMATCH, CLEARED, MATCHED, NEW, STATUSES, UNMATCHED
from ..functions.money import MONEY, money_sum, ratio

KPI_COLUMNS = ("run_date", "total_records", "matched", "unmatched", "new", "cleared", "amount_mismatch",
               "match_rate_pct", "unmatched_exposure", "avg_amount_variance")


def for_run_date(gold: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Gold rows of one run date (a partition filter on a partitioned table)."""
    return gold.filter(F.col("_run_date") == F.lit(str(run_date)).cast("date"))


def day_summary(gold_day: DataFrame, *by: str) -> DataFrame:
    """One row per (currency, status) with exact sums: the single pass over a
    day's gold rows that both the KPI row and the breakdown are read from.
    Its size is bounded by currencies x statuses (x ``by`` values), not by
    the data."""
    s = F.col("recon_status")
    abs_var = F.when(s.isin(MATCHED, AMOUNT_MISMATCH), F.abs(F.col("amount_variance")).try_cast(MONEY))
    return gold_day.groupBy(*by, "currency", "recon_status").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("amount").try_cast(MONEY)).alias("_amount"),
        F.sum(abs_var).alias("_var_sum"),
        F.count(abs_var).alias("_var_n"),
    )


def _kpi_aggs() -> list[Column]:
    s = F.col("recon_status")

    def n_of(label: str) -> Column:
        return F.coalesce(F.sum(F.when(s == label, F.col("_n"))), F.lit(0)).cast("bigint")

    return [
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_records"),
        n_of(MATCHED).alias("matched"),
        n_of(UNMATCHED).alias("unmatched"),
        n_of(NEW).alias("new"),
        n_of(CLEARED).alias("cleared"),
        n_of(AMOUNT_MISMATCH).alias("amount_mismatch"),
        F.round(F.coalesce(F.sum(F.when(s == UNMATCHED, F.col("_amount"))).cast("double"), F.lit(0.0)), 2)
         .alias("unmatched_exposure"),
        F.sum("_var_sum").cast("double").alias("_var_sum"),
        F.coalesce(F.sum("_var_n"), F.lit(0)).alias("_var_n"),
    ]


def _kpi_finish(agg: DataFrame, run_date_col: Column) -> DataFrame:
    return agg.select(
        run_date_col.alias("run_date"),
        "total_records", "matched", "unmatched", "new", "cleared", "amount_mismatch",
        ratio(F.col("matched"), F.col("total_records"), 2, scale=100.0).alias("match_rate_pct"),
        "unmatched_exposure",
        ratio(F.col("_var_sum"), F.col("_var_n"), 4).alias("avg_amount_variance"),
    )


def kpi_from_summary(summary: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Exactly one KPI row (zeros when the day is empty) from ``day_summary``."""
    return _kpi_finish(summary.agg(*_kpi_aggs()), F.lit(str(run_date)).cast("date"))


def breakdown_from_summary(summary: DataFrame, run_date: str | dt.date) -> DataFrame:
    return summary.select("currency", "recon_status", F.col("_n").alias("count"),
                          F.round(F.col("_amount").cast("double"), 2).alias("total_amount"),
                          F.lit(str(run_date)).cast("date").alias("_run_date"))


def kpi_daily(gold: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Exactly one KPI row for the run date (zeros when the day is empty).

    ``avg_amount_variance`` averages |variance| over MATCHED and
    AMOUNT_MISMATCH rows, rounded after the sum. ``unmatched_exposure`` adds amounts across currencies
    as they stand (no FX conversion).
    """
    return kpi_from_summary(day_summary(for_run_date(gold, run_date)), run_date)


def kpi_trend(gold: DataFrame) -> DataFrame:
    """One KPI row per run date present in gold, for cycle-over-cycle trends."""
    agg = day_summary(gold, "_run_date").groupBy("_run_date").agg(*_kpi_aggs())
    return _kpi_finish(agg, F.col("_run_date")).orderBy("run_date")


def currency_breakdown(gold_day: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Count and amount per (currency, status). NEW and CLEARED rows carry no
    currency, so they form the NULL-currency group."""
    return breakdown_from_summary(day_summary(gold_day), run_date)


def status_counts(gold_day: DataFrame) -> DataFrame:
    """Rows per status, every status listed (0 when absent): the status pie.

    One aggregate with a counter per status, turned into rows.
    """
    s = F.col("recon_status")
    agg = gold_day.agg(*[F.count_if(s == label).alias(label) for label in STATUSES])
    return agg.unpivot([], list(STATUSES), "recon_status", "records")


def exposure_by_currency(gold_day: DataFrame) -> DataFrame:
    """Open (UNMATCHED) amount and record count per currency, largest first."""
    return (gold_day.filter(F.col("recon_status") == UNMATCHED)
            .groupBy("currency")
            .agg(F.round(money_sum(F.col("amount")), 2).alias("exposure"), F.count(F.lit(1)).alias("records"))
            .orderBy(F.desc("exposure"), "currency"))


TOP_MISMATCH_COLUMNS = ("cash_id", "rada_id", "account_number", "trade_reference", "settlement_date",
                        "currency", "amount", "rada_amount", "amount_variance")


def top_mismatches(gold_day: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` largest breaks by |variance|; ties broken by key and ids.

    Planned as a per-task top-n followed by one merge of n rows per task.
    """
    return (gold_day.filter(F.col("recon_status") == AMOUNT_MISMATCH)
            .orderBy(F.desc(F.abs("amount_variance")), "business_key", "cash_id", "rada_id")
            .limit(n)
            .select(*TOP_MISMATCH_COLUMNS))


def run_summary(counts: DataFrame) -> DataFrame:
    """Long-format (step, rows) from a one-row frame of named counts."""
    values = [F.col(c).cast("bigint").alias(c) for c in counts.columns]
    return counts.select(*values).unpivot([], counts.columns, "step", "rows")
