"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: the six ASCII blanks, as a Java and RE2 character class body
BLANKS = r"\x20\x09-\x0D"
#: the same for Python's ``str.strip`` and ``bytes.strip``
STRIP = " \t\n\x0b\x0c\r"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the shared folder: it is computed once, its lineage
    ends, and a lost executor costs a re-read of the files."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def spread_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], salt_on: Sequence[str],
                  salts: int = 64) -> DataFrame:
    """Left join of ``rows`` to ``lookup`` (unique per ``keys``, not null)
    that holds when one key has a third of all rows.

    Rows get a salt from ``salt_on``; the pairs (key, salt) that occur, at most
    ``salts`` per key, take the looked-up columns along, and the rows then join
    on (key, salt). ``rows`` is read twice, so pass a checkpointed frame.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    present = salted.select(*keys, "_salt").distinct()
    near = present.join(lookup, list(keys))
    return salted.join(near, [*keys, "_salt"], "left").drop("_salt")


def per_worker(key, make):
    """``make()`` once per Python worker process and key. Functions are sent by
    value, so module globals do not outlive a task; ``sys.modules`` does."""
    held = sys.modules.setdefault("_ledgermatch_worker", types.ModuleType("_ledgermatch_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]
