"""Data-quality checks and the gate that stops a run on failure.

Each check is a one-row DataFrame with the columns of ``DQ_SCHEMA``. The
suite computes all metrics of a table in a single aggregate pass and turns
them into rows; only the gate collects, and it collects at most four rows
per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (CHECK_COMPLETENESS, CHECK_DUPLICATES, CHECK_NEGATIVE, CHECK_SCHEMA, FAIL, PASS,
                      Ledger, ReconConfig)

DQ_COLUMNS = ("check_name", "table", "status", "metric_value", "threshold", "detail")


class DataQualityError(RuntimeError):
    """Raised by the gate when a check fails; the run must stop."""


def _fmt(c: Column) -> Column:
    """Integer with thousands separators, e.g. 12,345."""
    return F.format_number(c.cast("bigint"), 0)


def _row(check: str, table: str, status: Column, metric: Column, threshold: float, detail: Column) -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table"), status.alias("status"),
            metric.cast("double").alias("metric_value"), F.lit(float(threshold)).alias("threshold"),
            detail.alias("detail")]


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, F.round(num.cast("double") / den.cast("double"), 4)).otherwise(F.lit(0.0))


def _complete(cols: Sequence[str], df: DataFrame) -> Column:
    """All listed columns populated; a NaN counts as missing, as in ``dropna``."""
    ok = F.lit(True)
    for c in cols:
        present = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            present = present & ~F.isnan(F.col(c))
        ok = ok & present
    return ok


def _metrics(df: DataFrame, required: Sequence[str], key_col: str) -> list[Column]:
    """Aggregates for all checks of one table; the key's distinct count
    counts NULL as one value."""
    return [
        F.count(F.lit(1)).alias("_total"),
        F.count_if(_complete(required, df)).alias("_complete"),
        (F.count_distinct(F.col(key_col)) + F.max(F.col(key_col).isNull().cast("int"))).alias("_unique"),
        F.count_if(F.col("amount") < 0).alias("_negative"),
    ]


def _completeness_row(table: str, threshold: float) -> list[Column]:
    score = _rate(F.col("_complete"), F.col("_total"))
    return _row(CHECK_COMPLETENESS, table, F.when(score >= threshold, PASS).otherwise(FAIL), score, threshold,
                F.concat(_fmt(F.col("_complete")), F.lit("/"), _fmt(F.col("_total")),
                         F.lit(" rows complete")))


def _duplicates_row(table: str, key_col: str, threshold: float) -> list[Column]:
    dups = F.col("_total") - F.coalesce(F.col("_unique"), F.lit(0))
    rate = _rate(dups, F.col("_total"))
    return _row(CHECK_DUPLICATES, table, F.when(rate <= threshold, PASS).otherwise(FAIL), rate, threshold,
                F.concat(F.lit(f"{key_col} repeated in "), _fmt(dups), F.lit(" of "), _fmt(F.col("_total")),
                         F.lit(" rows")))


def _negative_row(table: str) -> list[Column]:
    rate = _rate(F.col("_negative"), F.col("_total"))
    return _row(CHECK_NEGATIVE, table, F.when(F.col("_negative") == 0, PASS).otherwise(FAIL), rate, 0.0,
                F.concat(_fmt(F.col("_negative")), F.lit(" amounts below zero")))


def _schema_problems(df: DataFrame, expected: Sequence[str] | Mapping[str, str]) -> tuple[list[str], list[str]]:
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = list(expected)
    missing = [c for c in names if c not in present]
    wrong = []
    if isinstance(expected, Mapping):
        wrong = [c for c in names if c in present and present[c] != expected[c]]
    return missing, wrong


def _conversion_counts(df: DataFrame, wrong: Sequence[str], expected: Mapping[str, str]) -> list[Column]:
    """Per mistyped column, the values that do not convert to the contract's type."""
    return [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(expected[c]).isNull()).alias(f"_bad_{i}")
            for i, c in enumerate(wrong)]


def _schema_row(df: DataFrame, table: str, expected: Sequence[str] | Mapping[str, str]) -> list[Column]:
    """From an aggregate with ``_total`` and the conversion counts."""
    missing, wrong = _schema_problems(df, expected)
    parts = [F.concat(F.lit("rows read: "), _fmt(F.col("_total")))]
    if missing:
        parts.append(F.lit(f"absent: {', '.join(missing)}"))
    for i, c in enumerate(wrong):
        parts.append(F.concat(F.lit(f"{c} is not {expected[c]}, does not convert: "), _fmt(F.col(f"_bad_{i}"))))
    bad = len(missing) + len(wrong)
    return _row(CHECK_SCHEMA, table, F.lit(FAIL if bad else PASS), F.lit(float(bad)), 0.0, F.concat_ws("; ", *parts))


def _schema_aggs(df: DataFrame, expected: Sequence[str] | Mapping[str, str]) -> list[Column]:
    return _conversion_counts(df, _schema_problems(df, expected)[1], expected)


# --- single checks -------------------------------------------------------

def check_completeness(df: DataFrame, table: str, required_cols: Sequence[str], threshold: float = 0.98) -> DataFrame:
    """Share of rows with every required column populated; PASS if >= threshold.
    An empty table scores 0.0 and fails."""
    agg = df.agg(F.count(F.lit(1)).alias("_total"), F.count_if(_complete(required_cols, df)).alias("_complete"))
    return agg.select(*_completeness_row(table, threshold))


def check_duplicates(df: DataFrame, table: str, key_col: str, threshold: float = 0.005) -> DataFrame:
    """Share of rows repeating an earlier key value; PASS if <= threshold."""
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 (F.count_distinct(F.col(key_col)) + F.max(F.col(key_col).isNull().cast("int"))).alias("_unique"))
    return agg.select(*_duplicates_row(table, key_col, threshold))


def check_negative_amounts(df: DataFrame, table: str) -> DataFrame:
    """Metric is the share of negative amounts; PASS only when there are none."""
    agg = df.agg(F.count(F.lit(1)).alias("_total"), F.count_if(F.col("amount") < 0).alias("_negative"))
    return agg.select(*_negative_row(table))


def check_schema(df: DataFrame, table: str, expected: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Metric is the number of missing (or, given a name->type map, mistyped)
    columns; the detail tells how many rows were read and, per mistyped column,
    how many values do not convert."""
    agg = df.agg(F.count(F.lit(1)).alias("_total"), *_schema_aggs(df, expected))
    return agg.select(*_schema_row(df, table, expected))


def table_checks(df: DataFrame, table: str, ledger: Ledger, cfg: ReconConfig = ReconConfig(),
                 expected: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """The four checks of one table from one aggregate pass.

    If a column that the other checks need is missing, they are reported as
    FAIL instead of raising.
    """
    required = list(ledger.required_cols)
    expected = required if expected is None else expected
    absent = sorted((set(required) | {ledger.id_col, "amount"}) - set(df.columns))
    if absent:
        agg = df.agg(F.count(F.lit(1)).alias("_total"), *_schema_aggs(df, expected))
        checks = [F.struct(*_row(name, table, F.lit(FAIL), F.lit(None), threshold,
                                 F.lit(f"not computed, absent: {', '.join(absent)}")))
                  for name, threshold in ((CHECK_COMPLETENESS, cfg.completeness_threshold),
                                          (CHECK_DUPLICATES, cfg.duplicate_threshold), (CHECK_NEGATIVE, 0.0))]
    else:
        agg = df.agg(*_metrics(df, required, ledger.id_col), *_schema_aggs(df, expected))
        checks = [F.struct(*_completeness_row(table, cfg.completeness_threshold)),
                  F.struct(*_duplicates_row(table, ledger.id_col, cfg.duplicate_threshold)),
                  F.struct(*_negative_row(table))]
    return agg.select(F.explode(F.array(*checks, F.struct(*_schema_row(df, table, expected)))).alias("r")).select("r.*")


# --- suite and gate ------------------------------------------------------

def run_suite(tables: Sequence[tuple[DataFrame, str, Ledger]], cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """All checks for every (frame, table name, ledger) given."""
    out = None
    for df, name, ledger in tables:
        part = table_checks(df, name, ledger, cfg)
        out = part if out is None else out.unionByName(part)
    return out


def gate(results: DataFrame, fail_on_error: bool = True) -> list[dict]:
    """Collect the (few) result rows; raise ``DataQualityError`` if any failed."""
    rows = [r.asDict() for r in results.collect()]
    failed = [r for r in rows if r["status"] == FAIL]
    if failed and fail_on_error:
        names = ", ".join(f"{r['table']}.{r['check_name']}" for r in failed)
        raise DataQualityError(f"{len(failed)} data-quality checks failed: {names}")
    return rows
