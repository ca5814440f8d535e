"""Writers: run-date partitioned Parquet datasets on shared storage.

Tables are addressed by path. Re-runs replace whole run-date partitions
(dynamic partition overwrite), so running a day twice leaves one copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.zorder import quantiles, z_code
from ..operators.gold import replace_groups
from ..session import stored


def read(spark: SparkSession, source: str) -> DataFrame:
    """A dataset by path, or by catalog name (a name has no slash)."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset, or None before its first file is written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    return read_if_exists(spark, path) is not None


def clustered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lay rows out by ``cols`` across files (range partitioned) and within
    them (sorted), so Parquet min/max statistics let filters on those columns
    skip whole files as well as row groups. AQE sizes the range partitions.

    Range bounds come from a sampling pass over the input, so apply this to
    stored data (see ``optimize_layout``), not to an expensive computation.
    """
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "_run_date",
                         cluster_by: Sequence[str] | None = None, replace: Sequence[str] = (),
                         rebalance: bool = True) -> None:
    """Replace exactly the partitions present in ``df``; others are untouched.

    ``replace`` names partitions that are replaced even if ``df`` has no row
    for them: a stored one is then emptied.

    The partition mode is set on the write itself, not on the session.
    ``cluster_by``: each written file is sorted by these columns (no extra
    shuffle), so row-group statistics prune filters on them. Without it, a
    REBALANCE hint lets AQE size the write tasks, so rows that come straight
    from a scan (e.g. a few rejected rows per scan task) land in a few files
    of the advisory size instead of one per task. ``rebalance=False`` for rows that come
    out of a join or a stored table, which already lie in tasks of that size.
    """
    before = read_if_exists(df.sparkSession, path) if replace else None
    for value in replace if before is not None else ():
        same = F.col(partition_col) == F.lit(str(value)).cast(df.schema[partition_col].dataType)
        if not before.filter(same).isEmpty() and df.filter(same).isEmpty():
            df.drop(partition_col).limit(0).write.mode("overwrite").parquet(f"{path}/{partition_col}={value}")
    if cluster_by:
        out = df.sortWithinPartitions(partition_col, *cluster_by)
    else:
        out = df.hint("rebalance", partition_col) if rebalance else df
    (out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
     .partitionBy(partition_col).parquet(path))


def z_ordered(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """Lay rows out by the Z-order of ``cols``: files cover small boxes, so a filter on any one of the
    columns skips files. Reads ``df`` for its quantiles and for the range bounds: pass stored data."""
    code = z_code(df, quantiles(df, cols))
    ranged = df.withColumn("_z", code)
    ranged = ranged.repartitionByRange(files, "_z") if files else ranged.repartitionByRange("_z")
    return ranged.sortWithinPartitions("_z", *cols).drop("_z")


def optimize_layout(spark: SparkSession, path: str, run_dates: Sequence[str], cols: Sequence[str],
                    partition_col: str = "_run_date", *, z_order: bool = False, files: int | None = None) -> None:
    """Rewrite stored partitions clustered on ``cols`` (a maintenance step, like a
    clustering compaction): by range, the first column first, or with ``z_order`` alike for all
    columns. Filters then skip whole files. Reads only the given partitions; the rewrite
    replaces them after the job has succeeded. ``files``: how many to write per call with
    ``z_order`` (default: sized by AQE)."""
    dates = [F.lit(str(d)).cast("date") for d in run_dates]
    stored = spark.read.parquet(path).filter(F.col(partition_col).isin(dates))
    laid_out = z_ordered(stored, list(cols), files) if z_order else clustered(stored, list(cols))
    (laid_out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
     .partitionBy(partition_col).parquet(path))


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole dataset, partitions that ``df`` no longer has included."""
    df.write.mode("overwrite").options(partitionOverwriteMode="static", compression="zstd").partitionBy(*partition_by).parquet(path)


def upsert_gold(spark: SparkSession, rows: DataFrame, path: str, run_dates: Sequence[str] | None = None,
                cluster_by: Sequence[str] | None = None) -> None:
    """MERGE-like upsert of today's gold rows on (business_key, _run_date).

    Only the run dates present in ``rows`` are read and rewritten. When none
    of them is stored yet (the normal first run of a day) the rows are
    written straight away, so the classification behind them runs once.
    Otherwise the rows are stored below the shared checkpoint folder
    (they feed both the key set and the union), the stored partitions are
    pruned to those dates, the group replacement keeps stored rows whose key
    the new run did not produce, and the dynamic overwrite swaps those
    partitions in after the job has succeeded.
    """
    target = read_if_exists(spark, path)
    if run_dates is None:  # normally passed in: finding them costs a pass over ``rows``
        run_dates = [str(r[0]) for r in rows.select("_run_date").distinct().collect()]
    dates = [F.lit(str(d)).cast("date") for d in run_dates]
    touched = None if target is None else target.filter(F.col("_run_date").isin(dates))
    if touched is None or not touched.limit(1).collect():
        overwrite_partitions(rows, path, cluster_by=cluster_by, rebalance=False)
        return
    staged = stored(rows, "staged")
    merged = replace_groups(touched.select(*rows.columns), staged)
    overwrite_partitions(merged, path, cluster_by=cluster_by)


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed CSV export with a header line per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
