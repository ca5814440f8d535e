"""Mixing sources to target weights by hierarchical budgeting.

Rows hang in a tree (domain, language, source); every node has a positive
integer weight among its siblings. The token budget goes down from the root: a
node's budget is shared among its children by weight, a child takes at most
what its leaves can give (their tokens times ``max_epochs``), and what a child
cannot take goes to its siblings by weight. As a node is never given more than
its leaves can take, a shortage is made good among siblings first and reaches
an ancestor's other children only when all of them are full.

A leaf's allocation is a prefix of its epochs laid end to end. Each epoch is a
permutation of the leaf by a seeded hash. The position of a row in its epoch
is the tokens of all earlier hash buckets (summed first, so that no task sorts
a whole leaf) and of the earlier rows of its bucket.

All arithmetic is on integers, so the shares are exact and add up.

Defined results: null or blank texts have no tokens and are never selected; a
null level value counts as empty text; values without a weight have
``DEFAULT_WEIGHT``; a budget beyond the capacity selects every epoch; repeated
rows are rows of their own; an empty table gives no row; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, cut, text_or_empty

DEFAULT_WEIGHT = 1
LEVELS = ("domain", "lang", "source")


def count_words(text_col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(f"[^{BLANKS}]+")).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    if any(int(w) != w or w <= 0 for w in weights.values()):
        raise ValueError(f"weights of {level} must be positive integers")
    if not weights:
        return F.lit(DEFAULT_WEIGHT).cast("long")
    pairs = F.create_map(*(F.lit(x) for value, w in weights.items() for x in (value, int(w))))
    return F.coalesce(F.try_element_at(pairs, F.col(level)), F.lit(DEFAULT_WEIGHT)).cast("long")


def share(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Adds ``alloc`` to (parent..., name, weight, cap, budget): the budget of
    the parent shared by weight, no node above its cap.

    Nodes are taken by rising cap per weight: a node is full if its cap is at
    most its share of what the nodes before it left. The nodes that are not
    full share the rest; what rounding down leaves goes, one token each, to
    the first of them.
    """
    among = Window.partitionBy(*[F.col(c) for c in parent]) if parent else Window.partitionBy(F.lit(0))
    order = among.orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    judged = nodes.withColumn("_full", F.col("cap").cast(big) * weight_left <= F.col("weight").cast(big) * left)
    rest = judged.withColumns({
        "_rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(among), F.lit(0)),
        "_weights": F.sum(F.when(~F.col("_full"), F.col("weight"))).over(among)})
    exact = F.col("weight").cast(big) * F.col("_rest")
    floored = rest.withColumn("_floor", F.when(
        F.col("_full"), F.col("cap")).otherwise(F.floor((exact - exact % F.col("_weights")) / F.col("_weights"))).cast("long"))
    extra = F.col("_rest") - F.sum(F.when(~F.col("_full"), F.col("_floor"))).over(among)
    place = F.row_number().over(Window.partitionBy(*among_columns(parent), "_full").orderBy(F.col("cap") / F.col("weight"), name))
    return floored.withColumn("alloc", F.when(F.col("_full"), F.col("cap")).otherwise(
        F.least("cap", F.col("_floor") + F.when(place <= extra, 1).otherwise(0)))).drop(
        "_full", "_rest", "_weights", "_floor", "budget")


def among_columns(parent: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in parent] if parent else [F.lit(0)]


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: Column,
             max_epochs: int) -> DataFrame:
    """(levels..., tokens, alloc): the token allocation of every leaf of
    (levels..., tokens). ``budget`` is an expression over the sum ``tokens`` of all leaves."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0).cast("long")).alias("tokens")).select(
        budget.cast("long").alias("budget"))
    given = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumn(
            "weight", _weight(level, weights.get(level, {})))
        above = nodes.crossJoin(F.broadcast(total)) if given is None else nodes.join(given, path[:-1])  # one row
        given = share(above, path[:-1], level).select(*path, F.col("alloc").alias("budget"))
    return leaves.join(given.withColumnRenamed("budget", "alloc"), list(levels))


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int = 2,
        seed: int = 1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source", bucket_rows: int = 4096) -> DataFrame:
    """One row per selected row and epoch: ``doc_id``, the levels, ``epoch``,
    ``n_tokens`` and ``take_tokens`` (less than ``n_tokens`` only for the row
    at the end of a leaf's prefix)."""
    rows = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(domain.cast("string"), F.lit("")).alias("domain"),
        text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
        count_words(text_col).alias("n_tokens")))
    digits = max(2, math.ceil(math.log(max(rows.count() / bucket_rows, 1), 16)))
    spot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    epochs = (rows.filter("n_tokens > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs)))).withColumn("spot", spot)
              .withColumn("bucket", F.substring("spot", 1, digits)))
    sums = cut(epochs.groupBy(*LEVELS, "epoch", "bucket").agg(F.sum("n_tokens").alias("tokens")))
    leaves = sums.filter("epoch = 1").groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    allocated = allocate(cut(leaves), LEVELS, weights, budget, max_epochs)
    in_leaf = Window.partitionBy(*LEVELS, "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("earlier", F.coalesce(F.sum("tokens").over(in_leaf), F.lit(0).cast("long"))).drop("tokens").join(
        allocated, list(LEVELS)).select(
        *LEVELS, "epoch", "bucket", ((F.col("epoch") - 1) * F.col("tokens") + F.col("earlier")).alias("start"), "alloc")
    key = [*LEVELS, "epoch", "bucket"]
    in_bucket = Window.partitionBy(*key).orderBy("spot", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = epochs.join(starts.filter("start < alloc"), key).withColumn(
        "at", F.col("start") + F.coalesce(F.sum("n_tokens").over(in_bucket), F.lit(0)))
    return placed.filter("at < alloc").select(
        "doc_id", *LEVELS, F.col("epoch").cast("int").alias("epoch"), "n_tokens",
        F.least("n_tokens", F.col("alloc") - F.col("at")).alias("take_tokens"))
