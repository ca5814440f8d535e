"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_lookup


def _largest_neighbours_to_least(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node it knows."""
    both = cut(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return spread_lookup(both, least, ["u"], ["v"]).filter("v > u and v != m").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller_neighbours_to_least(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    found = spread_lookup(edges, least, ["u"], ["v"])
    return found.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v; longs, not null): the
    root is the least node of its component.

    Edges run from the larger to the smaller node. A round replaces them by
    (larger neighbours -> least neighbour) and then by (smaller neighbours ->
    least of them), until every component is a star. Every round is
    checkpointed; hubs are spread by salted look-ups.
    """
    now = cut(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        now = cut(_smaller_neighbours_to_least(cut(_largest_neighbours_to_least(now))))
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
