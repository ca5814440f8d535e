"""Dashboard measures, computed as DataFrames so any BI tool can read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AMOUNT_MISMATCH, NEW, UNMATCHED
from ..functions.money import MONEY

EXCEPTION_COLUMNS = ("business_key", "cash_id", "rada_id", "currency", "amount", "rada_amount",
                     "amount_variance", "recon_status", "mismatch_reason")


def matched_rate(kpis: DataFrame) -> DataFrame:
    """matched / (matched + unmatched) over the KPI rows; 0 on an empty denominator.

    Unlike ``match_rate_pct`` the denominator leaves out NEW, CLEARED and
    AMOUNT_MISMATCH, and the value is a fraction, not a percentage.
    """
    agg = kpis.agg(F.sum("matched").alias("m"), F.sum("unmatched").alias("u"))
    den = F.col("m") + F.col("u")
    return agg.select(F.when(den > 0, F.col("m").cast("double") / den.cast("double"))
                      .otherwise(F.lit(0.0)).alias("matched_rate"))


def exceptions(gold_day: DataFrame) -> DataFrame:
    """The open items: UNMATCHED, NEW and AMOUNT_MISMATCH rows. CLEARED rows
    are resolved and stay out."""
    return gold_day.filter(F.col("recon_status").isin(UNMATCHED, NEW, AMOUNT_MISMATCH)).select(*EXCEPTION_COLUMNS)


def with_exception_flag(exception_rows: DataFrame) -> DataFrame:
    """1 where a mismatch reason is present (not NULL, not blank), else 0."""
    reason = F.coalesce(F.trim(F.col("mismatch_reason")), F.lit(""))
    return exception_rows.withColumn("exception_flag", F.when(reason != "", F.lit(1)).otherwise(F.lit(0)))


def total_variance(cash: DataFrame, rada: DataFrame) -> DataFrame:
    """Total cash amount minus total RADA amount, exact, in one
    aggregate over both ledgers' amounts stacked with a side flag."""
    amounts = (cash.select(F.lit(0).alias("_side"), F.col("amount").try_cast(MONEY).alias("_amt"))
               .unionByName(rada.select(F.lit(1).alias("_side"), F.col("amount").try_cast(MONEY).alias("_amt"))))
    agg = amounts.agg(F.sum(F.when(F.col("_side") == 0, F.col("_amt"))).alias("c"),
                      F.sum(F.when(F.col("_side") == 1, F.col("_amt"))).alias("r"))
    diff = F.coalesce(F.col("c"), F.lit(0)) - F.coalesce(F.col("r"), F.lit(0))
    return agg.select(F.col("c").cast("double").alias("total_cash"), F.col("r").cast("double").alias("total_rada"),
                      diff.cast("double").alias("total_variance"))
