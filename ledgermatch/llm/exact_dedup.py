"""Exact de-duplication by a tree-merge of digest runs.

Every row gets a 64-bit digest of its normalised text (the grouping key of a run)
and a verifier (SHA-256 and length of the same text). Rows are dealt to
``runs`` leaf runs by their row number, so copies of one text are spread over
all leaves whatever their number. Each leaf run is reduced to one entry
per verified text: its smallest identifier and its count, a grouped minimum per
(run, digest, verifier); runs are not kept sorted, order is left to the planner. Then rounds
follow in which ``fan_in`` neighbouring runs (r // fan_in) exchange and merge
their entries, until one run is left. A round shuffles on (run, digest,
verifier), hence no task receives more than ``fan_in`` entries of one text,
and a run itself is spread over many tasks.

Only the entries of texts that occur more than once travel back: to the leaf
runs that hold them (at most ``runs`` rows per text), and from there to the
rows on (run, digest, verifier).

Defined results: a null text counts as empty; all empty texts are equal; a
null identifier is larger than any other; of rows that tie on the smallest
identifier exactly one stays; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, text_or_empty

_TEXT = ["_digest", "_sha", "_len"]


def normalised(text_col: str = "text") -> Column:
    """Each run of blanks becomes one space; null becomes empty."""
    return F.regexp_replace(text_or_empty(text_col), f"[{BLANKS}]+", " ")


def leaf_entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _row, _digest, _sha, _len) of every row, checkpointed: the row
    numbers are fixed from here on."""
    texts = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    return cut(texts.select(
        "_id", F.monotonically_increasing_id().alias("_row"), F.xxhash64("_norm").alias("_digest"),
        F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("_sha"), F.length("_norm").alias("_len")))


def merge_runs(entries: DataFrame, runs: int, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """(reduced leaf runs, the merged run)."""
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    leaves = entries.groupBy("_run", *_TEXT).agg(F.min(first).alias("_first"), F.count("*").alias("_n"))
    merged, width = leaves, runs
    while width > 1:
        width = -(-width // fan_in)
        merged = (merged.withColumn("_run", F.floor(F.col("_run") / fan_in))
                  .groupBy("_run", *_TEXT).agg(F.min("_first").alias("_first"), F.sum("_n").alias("_n")))
    return leaves, merged


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64,
                     fan_in: int = 8) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (the identifier
    that stays), ``group_size``, ``kept``, ``text_sha256``."""
    entries = leaf_entries(docs, id_col, text_col).withColumn("_run", F.pmod(F.xxhash64("_row"), F.lit(runs)))
    leaves, merged = merge_runs(entries, runs, fan_in)
    repeated = merged.filter("_n > 1").select(*_TEXT, "_first", "_n")
    back = leaves.select("_run", *_TEXT).join(repeated, _TEXT)
    rows = entries.join(back, ["_run", *_TEXT], "left")
    single = F.col("_n").isNull()
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.when(single, F.col("_id")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("_row") == F.col("_first.row"))).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    The losers' keys (identifier, text) are removed by an anti join. Keys that
    occur more than once with the winner among them go through
    ``dropDuplicates``, on their rows alone.
    """
    marks = cut(exact_duplicates(docs, id_col, text_col, **options).filter("group_size > 1")
                .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("kept").alias("_kept")))
    keys = marks.groupBy("_id", "_sha").agg(F.max("_kept").alias("_kept"), F.count("*").alias("_n"))
    lose, tied = keys.filter("not _kept or _n > 1"), cut(keys.filter("_kept and _n > 1"))
    rows = docs.withColumn("_text_sha", F.sha2(normalised(text_col).cast("binary"), 256))

    def same(side: DataFrame) -> Column:
        return rows[id_col].eqNullSafe(side["_id"]) & (rows["_text_sha"] == side["_sha"])

    stay = rows.join(lose, same(lose), "left_anti")
    if tied.isEmpty():  # as a rule: identifiers are unique
        return stay.drop("_text_sha")
    one_of = rows.join(tied, same(tied), "left_semi").dropDuplicates([id_col, "_text_sha"])
    return stay.unionByName(one_of).drop("_text_sha")
