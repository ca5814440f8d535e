"""Bronze ingest of extracts whose columns change: header-driven, additive, nothing lost.

The landing folder is read as a file stream of names (contents are not read for
it), so the checkpoint's source log decides which files are new. A batch's files are
grouped by their header line and each group is parsed with the columns in its
own order, so reordered headers load right and a new column is added to bronze.

The columns of bronze are kept as numbered versions in a folder beside the checkpoint. A
batch that brings new columns stores the next version before its rows. Columns are only
added: old files read null there, a column that a later file lacks is null in its rows. New
columns are text. A declared type that differs from the stored one is refused, and so is a file
without one of the declared columns that are mandatory, or with a column named twice.

A line that does not fit its header (too many or too few fields, an amount that is not a
number) is kept whole in ``RESCUED``, beside what could be parsed of it; ``standardise``
sends such rows to the quarantine. Empty lines are not rows, files without a line are passed over.

Rows go to one bronze folder per batch, which a repeated batch replaces: a
failure at any point leaves each row once.

Scale: a run reads the new files' lines once for the headers (a substring filter, one
line per file kept) and once to parse. The driver holds names and headers of the new
files; ``max_files_per_trigger`` bounds them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RESCUED, Ledger
from ..schemas import landing_schema
from ..sinks import tables

BATCH = "_batch"
_NAMES = "path string, modificationTime timestamp, length long, content binary"
_LINEAGE = "_ingested_ts timestamp, _source_file string, _batch_date date"


def stored_columns(spark: SparkSession, schema_path: str) -> list[tuple[str, str]]:
    """(name, type) of the bronze columns in their order, by the last stored version."""
    stored = tables.read_if_exists(spark, schema_path)
    if stored is None:
        return []
    last = stored.agg(F.max("_version")).first()[0]
    return [(r["name"], r["type"]) for r in stored.filter(F.col("_version") == last).orderBy("position").collect()]


def merged_columns(stored: Sequence[tuple[str, str]], declared: Sequence[tuple[str, str]],
                   seen: Sequence[str]) -> list[tuple[str, str]]:
    """The stored columns, then those declared, then those seen, each once."""
    known, given = dict(stored), dict(declared)
    if changed := [f"{n}: {known[n]} to {t}" for n, t in given.items() if known.get(n, t) != t]:
        raise ValueError(f"column types may not change: {changed}")
    new = [n for n in dict.fromkeys([*given, *seen]) if n not in known]
    return [*stored, *((n, given.get(n, "string")) for n in new)]


def headers(spark: SparkSession, paths: Sequence[str], ledger: Ledger, sep: str) -> dict[str, list[str]]:
    """The header's column names per file: its first line that names the ledger's id column."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    first = (lines.filter((F.col("block") == 0) & F.col("value").contains(ledger.id_col))
             .groupBy("path").agg(F.min_by("value", "at").alias("line")))
    return {r["path"]: [n.strip().strip('"') for n in r["line"].lstrip("\ufeff").split(sep)] for r in first.collect()}


def _checked(found: dict[str, list[str]], paths: Sequence[str], ledger: Ledger) -> dict[tuple[str, ...], list[str]]:
    """Files by header; refuses files that cannot be loaded."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        names = found.get(path, [])
        if len(set(names)) < len(names) or "" in names:
            raise ValueError(f"{path} names a column twice or not at all: {names}")
        if missing := [c for c in ledger.required_cols if c not in names]:
            raise ValueError(f"{path} lacks the columns {missing}")
        groups.setdefault(tuple(names), []).append(path)
    return groups


def _parsed(spark: SparkSession, names: Sequence[str], paths: Sequence[str], types: dict[str, str], sep: str) -> DataFrame:
    schema = T.StructType()
    for n in names:
        schema = schema.add(n, types[n])
    return (spark.read.option("header", True).option("enforceSchema", True).option("sep", sep)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
            .schema(schema.add(RESCUED, "string")).csv(list(paths))
            .withColumn("_ingested_ts", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_batch_date", F.current_date()))


def ingest_evolving(spark: SparkSession, source_path: str, bronze_path: str, checkpoint_path: str, schema_path: str,
                    ledger: Ledger, *, sep: str = ",", declared: T.StructType | None = None,
                    max_files_per_trigger: int | None = None) -> None:
    """Append every new landing file to bronze and wait for it. ``declared``: the
    types of known columns (default: the ledger's landing schema)."""
    known = [(f.name, f.dataType.simpleString()) for f in (declared or landing_schema(ledger)).fields]
    merged_columns(stored_columns(spark, schema_path), known, [])  # a changed type is refused even without new files

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.filter("length > 0").select("path").collect()]
        if not paths:
            return
        groups = _checked(headers(spark, paths, ledger, sep), paths, ledger)
        stored = stored_columns(spark, schema_path)
        merged = merged_columns(stored, known, [n for names in sorted(groups) for n in names])
        if merged != stored:
            version = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(merged)], "position int, name string, type string")
            tables.overwrite_partitions(version.withColumn("_version", F.lit(int(batch_id))), schema_path, "_version")
        parts = [_parsed(spark, names, files, dict(merged), sep) for names, files in sorted(groups.items())]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        tables.overwrite(rows, f"{bronze_path}/{BATCH}={int(batch_id)}")

    reader = spark.readStream.format("binaryFile").schema(_NAMES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    query = (reader.load(source_path).select("path", "length").writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()


def read_bronze(spark: SparkSession, bronze_path: str, schema_path: str) -> DataFrame:
    """All of bronze with the columns of the last schema version (no file footer is merged for it)."""
    columns = ", ".join(f"`{n}` {t}" for n, t in stored_columns(spark, schema_path))
    if not columns:
        raise ValueError(f"no schema is stored at {schema_path}")
    return spark.read.schema(f"{columns}, {RESCUED} string, {_LINEAGE}, {BATCH} long").parquet(bronze_path)
