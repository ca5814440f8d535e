"""Bronze ingest: landing CSV extracts -> append-only Parquet, exactly once.

A file-source stream with an explicit schema picks up only files it has not
seen; the checkpoint's source log is what makes a re-run ingest nothing
twice. ``availableNow`` drains what is there and stops, so a daily job can
call this like a batch step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Ledger
from ..schemas import landing_schema
from ..sinks.tables import exists
from ..sources.fixed_width import FieldSpec, parse


@dataclass
class IngestResult:
    table: str
    new_rows: int
    total_rows: int


def landing_stream(spark: SparkSession, source_path: str, ledger: Ledger, *, sep: str = ",",
                   amount_as_text: bool = False, fixed_width: FieldSpec | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the landing folder with lineage columns.

    Delimited files: ``enforceSchema=false`` checks each file's header
    against the schema by name, so a file with reordered columns fails
    instead of loading shifted values. ``fixed_width``: the files are plain
    text cut at the given field widths (all fields arrive as text).
    """
    reader = spark.readStream
    if max_files_per_trigger:  # bounded micro-batches; availableNow still drains everything
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fixed_width is not None:
        raw = parse(reader.format("text").load(source_path), fixed_width)
    else:
        raw = (reader.format("csv")
               .option("header", True)
               .option("enforceSchema", False)
               .option("sep", sep)
               .schema(landing_schema(ledger, amount_as_text=amount_as_text))
               .load(source_path))
    return (raw
            .withColumn("_ingested_ts", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_batch_date", F.current_date()))


def _row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet dataset (footer metadata only); 0 before its first file."""
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def ingest(spark: SparkSession, source_path: str, bronze_path: str, checkpoint_path: str, ledger: Ledger,
           *, sep: str = ",", amount_as_text: bool = False, fixed_width: FieldSpec | None = None,
           max_files_per_trigger: int | None = None) -> IngestResult:
    """Append every new landing file to the bronze dataset and wait for it.

    ``new_rows`` is the growth of bronze over this run (exact for any number
    of micro-batches; the ingest is the only writer of its bronze dataset).
    """
    before = _row_count(spark, bronze_path)
    stream = landing_stream(spark, source_path, ledger, sep=sep, amount_as_text=amount_as_text,
                            fixed_width=fixed_width, max_files_per_trigger=max_files_per_trigger)
    query = (stream.writeStream.format("parquet")
             .outputMode("append")
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .start(bronze_path))
    query.awaitTermination()
    total = _row_count(spark, bronze_path)
    return IngestResult(bronze_path, total - before, total)


def validate_schema(df: DataFrame, table: str, ledger: Ledger) -> DataFrame:
    """Post-ingest check: mandatory columns present, with the row count.

    One row: table, row_count, missing_mandatory_columns, schema_valid.
    """
    missing = [c for c in ledger.required_cols if c not in df.columns]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table"), "row_count",
        F.lit(", ".join(missing)).alias("missing_mandatory_columns"),
        F.lit(not missing).alias("schema_valid"))
