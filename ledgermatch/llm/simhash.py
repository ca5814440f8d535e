"""SimHash near-duplicates, linked by BK-trees.

1. A document's fingerprint: a bit is 1 if set in over half the hashes of its
   word shingles (repeats included).
2. Equal fingerprints are one node with the smallest identifier of its rows.
3. Two fingerprints within ``radius`` bits agree on at least one of the blocks
   that the pigeonhole principle gives (``radius + 1`` blocks; with more
   fingerprints, more blocks of which several must agree, see ``block_keys``),
   so each fingerprint joins one shard per block key. A shard's fingerprints
   form a BK-tree: children are keyed by their Hamming distance to the parent.
   Every fingerprint of the shard is searched in its tree; from a node at
   distance d only edges d - radius .. d + radius are followed.
4. Trees travel to their queries. A shard above ``shard_limit`` fingerprints
   sends its tree to several parts, and each part searches its share of the
   shard's fingerprints. Parts stream through a task sorted by part; the trees
   of many small shards are built and searched together, level by level.
5. A part reports links as edges to the least fingerprint of each group it
   finds (a spanning star: at most one edge per fingerprint, no pairs), and
   the edges' connected components are contracted across parts.

Defined results: null and blank texts have fingerprint zero and link like any
other; a text with fewer words than the shingle has one shingle, all its
words; null identifiers are ignored when the smallest is sought (null if there
is no other); repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_lookup, text_or_empty
from .components import components

_SEED = 42  # fixed value: the seed of the shingle hash


# ---- fingerprints ---------------------------------------------------------

def fingerprint(text: str, words: int) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    tokens = text.encode().lower().split()  # of bytes: A-Z and the six ASCII blanks alone
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
    starts = [0, *ends[:-1]]
    n = max(len(tokens) - words + 1, 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], _SEED) for a, b in zip(starts[:n], ends[-n:], strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65_536):
        bits = np.unpackbits(hashes[lo:lo + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint_column(text: Column, words: int) -> Column:
    """The fingerprint as a signed long."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py() or "", words) for t in texts], np.uint64).view(np.int64))

    return of(text)


# ---- block keys -----------------------------------------------------------

def block_keys(fp: Column, radius: int, agree: int) -> list[Column]:
    """One key per way to choose ``agree`` of ``radius + agree`` blocks:
    fingerprints within the radius spoil at most ``radius`` blocks, so they
    share at least one key."""
    blocks = radius + agree
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), agree)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        keys.append(F.struct(F.lit(n).alias("table"), fp.bitwiseAND(F.lit(mask - (mask >> 63 << 64))).alias("key")))
    return keys


def choose_agree(count: int, radius: int, per_shard: int = 4096) -> int:
    """The least number of agreeing blocks that leaves ``per_shard`` evenly
    spread fingerprints a shard. Any number finds all links."""
    agree = 1
    while agree < 4 and count / 2.0 ** (64 * agree / (radius + agree)) > per_shard:
        agree += 1
    return agree


# ---- BK-trees of many shards at once --------------------------------------

def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree per shard, over distinct fingerprints.

    ``shard`` numbers the shard of each fingerprint, 0 .. n - 1, each at least
    once. Node i is fingerprint i. The edges are sorted by (parent, distance).
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        self.roots = np.full(int(shard.max()) + 1, -1, np.int64)
        first = np.unique(shard, return_index=True)
        self.roots[first[0]] = first[1]
        waiting = np.setdiff1d(np.arange(len(fp)), first[1], assume_unique=True)
        parent, edges = self.roots[shard[waiting]], []
        while len(waiting):  # one level deeper: the first of each (parent, distance) becomes its child
            slot = parent * 65 + _distance(fp[waiting], fp[parent])
            values, at, back = np.unique(slot, return_index=True, return_inverse=True)
            child = waiting[at]
            edges.append(np.stack([values, child]))
            stays = np.ones(len(waiting), bool)
            stays[at] = False
            waiting, parent = waiting[stays], child[back[stays]]
        slots = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64)
        order = np.argsort(slots[0], kind="stable")
        self.slots, self.children = slots[0][order], slots[1][order]

    def search(self, shard: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of (query, node) within the radius, level by level."""
        stack = [(np.arange(len(fp)), self.roots[shard])]
        while stack:
            query, node = stack.pop()
            if len(query) > 500_000:  # bounds the frontier that is held at once
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = _distance(fp[query], self.fp[node])
            near = d <= radius
            yield query[near], node[near]
            lo = np.searchsorted(self.slots, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.slots, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            total = int(n.sum())
            if total:
                step = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                stack.append((np.repeat(query, n), self.children[step]))


def _roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each node's group, by repeated minimum and
    pointer jumping over each batch of links."""
    root = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(root, jumped := root[root]):
                root = jumped
    return root


def _link_parts(radius: int, chunk: int):
    """Rows (table, key, part, fp, query) sorted by part: emit the edges of each part's groups."""
    def linked(columns: list[np.ndarray]) -> pa.RecordBatch:
        table, key, part, fp, query = columns
        new = np.ones(len(fp), bool)
        new[1:] = (table[1:] != table[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        shard = np.cumsum(new) - 1
        bits = fp.view(np.uint64)
        asked = np.flatnonzero(query)
        forest = Forest(shard, bits)
        found = ((asked[q], n) for q, n in forest.search(shard[asked], bits[asked], radius))
        root = _roots(len(fp), found)
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if sum(len(h[0]) for h in held) < chunk:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0))
            if len(changes):  # the last part may go on in the next batch
                at = int(changes[-1]) + 1
                yield linked([c[:at] for c in columns])
                held = [[c[at:] for c in columns]]
            else:
                held = [columns]
        if held:
            yield linked([np.concatenate(c) for c in zip(*held, strict=True)])
    return run


def near_edges(fps: DataFrame, radius: int, shard_limit: int = 8192, most_hot: int = 1024) -> DataFrame:
    """(u, v): edges that connect exactly the groups of fingerprints (column
    ``fp``, distinct, checkpointed) linked within ``radius`` bits."""
    count = fps.count()
    keys = block_keys(F.col("fp"), radius, choose_agree(count, radius))
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.table", "k.key", "fp")
    # shards beyond the limit; as all shards hold count x len(keys) rows, fewer than most_hot
    limit = max(shard_limit, count * len(keys) // most_hot)
    hot = {(r["table"], r["key"]): -(-r["n"] // limit) for r in rows.groupBy("table", "key").agg(
        F.count("*").alias("n")).filter(F.col("n") > limit).collect()}
    rows = rows.withColumn("parts", F.lit(1))
    if hot:
        table_of_hot = fps.sparkSession.createDataFrame(
            [(t, k, n) for (t, k), n in hot.items()], "table int, key long, more int")
        rows = rows.join(F.broadcast(table_of_hot), ["table", "key"], "left").withColumn(
            "parts", F.coalesce("more", "parts"))
    dealt = (rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .select("table", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fp", "own")
             .select("table", "key", "part", "fp", (F.col("own") == F.col("part")).alias("query"))
             .repartition("table", "key", "part").sortWithinPartitions("table", "key", "part", "fp"))
    return dealt.mapInArrow(_link_parts(radius, 200_000), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3,
                    shard_limit: int = 8192) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (signed long),
    ``component_id``, the smallest identifier reachable over links of
    ``radius`` or fewer differing bits, and ``root``, the component's least
    fingerprint."""
    prints = cut(docs.select(F.col(id_col).alias("doc_id"),
                             fingerprint_column(text_or_empty(text_col), words).alias("fp")))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = cut(components(near_edges(nodes.select("fp"), radius, shard_limit)))
    rooted = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = spread_lookup(cut(rooted), least, ["root"], ["fp"]).select("fp", "root", "component_id")
    return spread_lookup(prints.withColumn("_n", F.monotonically_increasing_id()), named, ["fp"], ["_n"]).select(
        "doc_id", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                         radius: int = 3, shard_limit: int = 8192) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each component
    the row with the smallest identifier, exactly one.

    Rows whose identifier occurs once are decided by it. Repeated and null
    identifiers are decided by (identifier, fingerprint), on their rows alone.
    """
    marks = cut(near_duplicates(docs, id_col, text_col, words, radius, shard_limit).withColumnRenamed("doc_id", "_id"))
    by_id = marks.groupBy("_id").agg(F.count("*").alias("_n"), F.min("component_id").alias("_first"))
    several = cut(by_id.filter("_n > 1 or _id is null").select("_id"))
    gone = by_id.filter("_n > 1 or _id is null or _id != _first").select("_id")

    def same(side: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(side["_id"])

    once = docs.join(gone, same(gone), "left_anti")
    if several.isEmpty():  # as a rule: identifiers are unique
        return once
    winner = F.min(F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("fp").alias("fp")))
    winners = marks.groupBy("root").agg(winner.alias("w")).select(F.col("w.id").alias("_id"), F.col("w.fp").alias("_of"))
    rows = docs.join(several, same(several), "left_semi").withColumn(
        "_fp", fingerprint_column(text_or_empty(text_col), words))
    chosen = rows.join(winners, rows[id_col].eqNullSafe(winners["_id"]) & (rows["_fp"] == winners["_of"]), "left_semi")
    return once.unionByName(chosen.dropDuplicates([id_col, "_fp"]).drop("_fp"))
