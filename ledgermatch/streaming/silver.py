"""Incremental silver: new bronze files are standardised and upserted, nothing is rebuilt.

Bronze is read as a file stream with a checkpoint, so each run sees the files
that came since the one before. A batch's valid rows are upserted into silver, which is
partitioned by a hash bucket of the ledger id: buckets in which an id of the batch is already
stored are read, merged (latest copy per id) and replaced; the batch's rows of
all other buckets are appended. Rejects go to the quarantine partition of their batch.

A batch may be applied again after a failure at any point: its ids are then
found stored, merging the same copies changes nothing, and its quarantine partition is
replaced. The survivor per id is a maximum over all copies, so silver equals a
rebuild from all of bronze whatever the batches were.

Scale: a run parses its new rows only; of silver it reads the ids in the batch's
buckets and the rows of the buckets with resent ids. ``buckets`` bounds what one resent
id rewrites (1 / buckets of silver) and the list of buckets, the only thing collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RADA, Ledger, ReconConfig
from ..operators.standardise import latest_per_id, standardise
from ..session import checkpoint_root
from ..sinks import tables

BUCKET, BATCH = "_bucket", "_batch"


def _buckets_of(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def apply_batch(rows: DataFrame, batch_id: int, ledger: Ledger, silver_path: str, quarantine_path: str,
                buckets: int = 256, cfg: ReconConfig = ReconConfig()) -> dict[str, int]:
    """Standardise and upsert one batch of bronze rows; returns the numbers of buckets replaced and appended to."""
    spark = rows.sparkSession
    checkpoint_root(spark)
    std = standardise(rows, ledger, amount_scale=cfg.rada_amount_scale if ledger == RADA else 1.0)
    tables.overwrite_partitions(std.quarantine.withColumn(BATCH, F.lit(int(batch_id))), quarantine_path, BATCH,
                                replace=[str(batch_id)])
    fresh = std.clean.withColumn(BUCKET, F.pmod(F.xxhash64(ledger.id_col), F.lit(buckets)).cast("int")).checkpoint(eager=True)
    touched, stored = _buckets_of(fresh), tables.read_if_exists(spark, silver_path)
    again: list[int] = []
    if stored is not None:
        ids = stored.filter(F.col(BUCKET).isin(touched)).select(ledger.id_col)
        again = _buckets_of(fresh.join(ids, ledger.id_col, "left_semi"))
        if again:
            mixed = stored.filter(F.col(BUCKET).isin(again)).unionByName(fresh.filter(F.col(BUCKET).isin(again)))
            # checkpointed: the partitions that it reads are the ones that it replaces
            tables.overwrite_partitions(latest_per_id(mixed, ledger.id_col).checkpoint(eager=True), silver_path, BUCKET)
    new = fresh.filter(~F.col(BUCKET).isin(again)) if again else fresh
    if len(again) < len(touched):
        new.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(silver_path)
    return {"replaced": len(again), "appended": len(touched) - len(again)}


def standardise_new(spark: SparkSession, ledger: Ledger, bronze_path: str, silver_path: str, quarantine_path: str,
                    checkpoint_path: str, buckets: int = 256, cfg: ReconConfig = ReconConfig(),
                    max_files_per_trigger: int | None = None) -> None:
    """Apply every bronze file that came since the last run, and wait for it."""
    reader = spark.readStream.schema(spark.read.parquet(bronze_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))

    def apply(rows: DataFrame, batch_id: int) -> None:
        apply_batch(rows, batch_id, ledger, silver_path, quarantine_path, buckets, cfg)
    query = (reader.parquet(bronze_path).writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()
