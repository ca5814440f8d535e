"""Silver standardisation: type, normalise, split clean/quarantine, de-duplicate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REJECTION_REASON, RESCUED, Ledger
from ..functions.clean import mandatory_ok, normalised_columns
from ..session import checkpoint_root

_OK = "_mandatory_ok"
#: repeated ids few enough to be sent to every task
_LISTED = 100_000


@dataclass
class Standardised:
    quarantine: DataFrame   # typed, rejected rows with their reason
    accepted: DataFrame     # typed, valid, before de-duplication
    id_col: str
    standardised_ts: Column | None = None

    @cached_property
    def clean(self) -> DataFrame:
        """Typed, valid, one row per ledger id (the ids are counted when this is first read)."""
        clean = latest_per_id(self.accepted, self.id_col)
        return clean if self.standardised_ts is None else clean.withColumn("_standardised_ts", self.standardised_ts)


def normalise(bronze: DataFrame, ledger: Ledger, amount_scale: float = 1.0) -> DataFrame:
    """Typed and normalised extract plus a never-NULL validity flag. A row
    whose landing line had to be rescued (where bronze keeps them) is not valid."""
    ok = mandatory_ok(ledger)
    if RESCUED in bronze.columns:
        ok = ok & F.col(RESCUED).isNull()
    return bronze.withColumns(normalised_columns(amount_scale)).withColumn(_OK, ok)


def latest_per_id(df: DataFrame, id_col: str, order_cols: list[str] | None = None) -> DataFrame:
    """One survivor per id: the latest ``_ingested_ts``, ties broken by the
    remaining columns (so the survivor is reproducible).

    The ids alone (their hashes) are counted first. Rows whose id came once need no shuffle;
    those of repeated ids, and of an id that shares its hash, are reduced. Where more than
    ``_LISTED`` repeat, all rows are.
    """
    checkpoint_root(df.sparkSession)
    repeated = (df.groupBy(F.xxhash64(id_col).alias("_id")).count().filter("count > 1").select("_id")
                .limit(_LISTED + 1).checkpoint(eager=True))
    number = repeated.count()
    if number == 0:
        return df.select(id_col, *[c for c in df.columns if c != id_col])
    if number > _LISTED:
        return _reduced(df, id_col, order_cols)
    listed = F.broadcast(repeated)
    again, once = (df.join(listed, F.xxhash64(df[id_col]) == listed["_id"], how) for how in ("left_semi", "left_anti"))
    kept = _reduced(again, id_col, order_cols)
    return kept.unionByName(once.select(*kept.columns))


def _reduced(df: DataFrame, id_col: str, order_cols: list[str] | None = None) -> DataFrame:
    """The survivors, written as ``max(struct(...))`` per id: an aggregate, so copies are
    combined map-side before the shuffle and a heavily repeated id never
    piles up in one task."""
    cols = [c for c in df.columns if c != id_col]
    if order_cols is None:
        order_cols = (["_ingested_ts"] if "_ingested_ts" in cols else []) + [c for c in cols if c != "_ingested_ts"]
    packed = F.struct(*[F.col(c).alias(c) for c in order_cols])
    return (df.groupBy(id_col).agg(F.max(packed).alias("_row"))
            .select(F.col(id_col), *[F.col(f"_row.{c}").alias(c) for c in cols]))


def standardise(bronze: DataFrame, ledger: Ledger, *, amount_scale: float = 1.0,
                standardised_ts: Column | None = None) -> Standardised:
    """Split a bronze extract into clean (de-duplicated) and quarantined rows.

    Every input row ends in exactly one of ``accepted`` or ``quarantine``.
    """
    norm = normalise(bronze, ledger, amount_scale)
    accepted = norm.filter(F.col(_OK)).drop(_OK, RESCUED)
    quarantine = (norm.filter(~F.col(_OK)).drop(_OK)
                  .withColumn("_rejection_reason", F.lit(REJECTION_REASON)))
    return Standardised(quarantine=quarantine, accepted=accepted, id_col=ledger.id_col, standardised_ts=standardised_ts)


def standardise_counts(bronze: DataFrame, ledger: Ledger, amount_scale: float = 1.0) -> DataFrame:
    """One-row summary in one pass: input, accepted, rejected and clean (distinct id) counts."""
    norm = normalise(bronze, ledger, amount_scale)
    ok = F.col(_OK)
    return norm.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(ok).alias("accepted_rows"),
        F.count_if(~ok).alias("quarantine_rows"),
        F.count_distinct(F.when(ok, F.col(ledger.id_col))).alias("clean_rows"),
    )
