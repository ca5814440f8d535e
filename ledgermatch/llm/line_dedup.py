"""Line de-duplication with a sharded minimal perfect hash.

A line's key is the line stripped of blanks and lower-cased (A-Z). Keys of at
least ``min_chars`` code points that ``min_docs`` documents hold lose all their
lines, but for those in the document with the largest identifier.

1. Every document emits a 128-bit hash of each of its distinct keys; hashes
   are counted (documents, largest identifier) with map-side combine.
2. The hashes that reach ``min_docs`` are dealt to shards of bounded size. A
   shard becomes one index row: a minimal perfect hash (levels of bit arrays
   with ranks), and by its slots an array of 64-bit fingerprints, an array of
   counts and an array of largest identifiers.
3. Documents probe the arrays: their hashes travel to the shard's task, after
   the index row of the same part (rows are sorted so that it comes first), and
   stream through it in batches. A shard with a hot line is copied to several
   parts and its probes are salted by document. Only the shards above 1/512 of
   all probes are copied, so the list of copies has at most 512 entries.
4. Hits return as one list of hashes per document, and the document drops
   those lines.

Every hash below ``min_docs`` can never lose a line, so it takes no slot; the
fingerprint turns it away.

Defined results: a null text is one empty line; a null identifier is smaller
than any other; each row is a document of its own, and rows that share the
largest identifier all keep their lines; extra columns are ignored.
Identifiers are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import STRIP, cut, text_or_empty

_LOWEST = -(2**63)  # stands for a null identifier
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- keys of a text -------------------------------------------------------

def _key(line: str, min_chars: int) -> bytes | None:
    key = line.strip(STRIP)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _hash_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, found = batch.column(0), [], []
            for text in batch.column(1):
                keys = {_key(x, min_chars) for x in text.as_py().split("\n")} - {None}
                sizes.append(len(keys))
                found.extend(keys)
            halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids.to_numpy(zero_copy_only=False), sizes), pa.int64()),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=["id", "h1", "h2"])
    return run


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, h1, h2): the distinct keys of each row of (id, text)."""
    return docs.mapInArrow(_hash_rows(min_chars), "id long, h1 long, h2 long")


# ---- the index of a shard -------------------------------------------------

def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit hash of (h1, h2) for each level (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = h1 + np.uint64(((2 * level + 1) * 0x9E3779B97F4A7C15) & int(_MASK))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + h2
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class ShardIndex:
    """Minimal perfect hash over (h1, h2) with fingerprint, count and largest-identifier arrays."""

    def __init__(self, levels: list[np.ndarray], fingerprints, counts, last):
        self.levels, self.fingerprints, self.counts, self.last = levels, fingerprints, counts, last
        self.ranks, self.starts, at = [], [], 0
        for bits in levels:
            total = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(total - 1)
            self.starts.append(at)
            at += int(total[-1])

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, last: np.ndarray) -> ShardIndex:
        levels, left = [], np.arange(len(h1))
        while len(left):
            size = max(2 * len(left), 64)
            at = (_mix(h1[left], h2[left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        index = cls(levels, np.zeros(len(h1), np.uint64), np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64))
        slot = index.slots(h1, h2)
        index.fingerprints[slot], index.counts[slot], index.last[slot] = h2, counts, last
        return index

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key of the index; for other keys any slot, or -1."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (bits, rank, start) in enumerate(zip(self.levels, self.ranks, self.starts, strict=True)):
            at = (_mix(h1[left], h2[left], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at] == 1
            out[left[here]] = start + rank[at[here]]
            left = left[~here]
        return out

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 for keys that are not in the index."""
        slot = self.slots(h1, h2)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == h2[known]
        return np.where(known, slot, -1)

    def pack(self) -> dict:
        return {"sizes": [len(b) for b in self.levels], "bits": b"".join(np.packbits(b).tobytes() for b in self.levels),
                "fingerprints": self.fingerprints.tobytes(), "counts": self.counts.tobytes(),
                "last": self.last.tobytes()}

    @classmethod
    def unpack(cls, row: dict) -> ShardIndex:
        levels, at = [], 0
        for size in row["sizes"]:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(row["bits"], np.uint8, n, at), count=size))
            at += n
        return cls(levels, np.frombuffer(row["fingerprints"], np.uint64), np.frombuffer(row["counts"], np.int64),
                   np.frombuffer(row["last"], np.int64))


_INDEX = "struct<sizes:array<long>,bits:binary,fingerprints:binary,counts:binary,last:binary>"


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, index): one row per shard of (h1, h2, n, last)."""
    def build(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("shard", "h1", "h2", "n", "last")}
        index = ShardIndex.build(col["h1"].view(np.uint64), col["h2"].view(np.uint64), col["n"], col["last"])
        kind = pa.struct([("sizes", pa.list_(pa.int64())), *((c, pa.binary()) for c in (
            "bits", "fingerprints", "counts", "last"))])
        return pa.table({"shard": pa.array([int(col["shard"][0])], pa.int64()),
                         "index": pa.array([index.pack()], kind)})

    return counts.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard").applyInArrow(
        build, f"shard long, index {_INDEX}")


# ---- probing --------------------------------------------------------------

def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, index row first): emit the (id, key) whose line is dropped."""
    part, index = None, None
    for batch in batches:
        shard, salt, ids, h1, h2 = (batch.column(n).to_numpy(zero_copy_only=False) for n in (
            "shard", "salt", "id", "h1", "h2"))
        own = batch.column("index")
        edges = np.flatnonzero((shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])) + 1
        for lo, hi in zip([0, *edges], [*edges, len(shard)], strict=True):
            if lo == hi:
                continue
            if (shard[lo], salt[lo]) != part:
                part, index = (shard[lo], salt[lo]), None
            if own[lo].is_valid:
                index, lo = ShardIndex.unpack(own[lo].as_py()), lo + 1
            if index is None or lo == hi:
                continue
            a, b = h1[lo:hi].astype(np.int64).view(np.uint64), h2[lo:hi].astype(np.int64).view(np.uint64)
            slot = index.probe(a, b)
            who = ids[lo:hi].astype(np.int64)
            hit = np.flatnonzero((slot >= 0) & (index.last[slot] != who))
            keys = np.stack([a[hit], b[hit]], axis=1).astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(who[hit]), pa.array([keys[i:i + 16] for i in range(0, len(keys), 16)], pa.binary())],
                names=["id", "key"])


def _copies(counts: DataFrame, shards: int, most: int = 512) -> dict[int, int]:
    """shard -> number of parts, for the shards whose counted probes exceed
    1/``most`` of all counted probes: fewer than ``most`` entries."""
    load = cut(counts.groupBy(F.pmod("h1", F.lit(shards)).alias("shard")).agg(F.sum("n").alias("n")))
    share = (load.agg(F.sum("n")).first()[0] or 0) / most
    return {r["shard"]: int(r["n"] // share) + 1 for r in load.filter(F.col("n") > share).collect()}


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, shard_keys: int) -> DataFrame:
    """(id, keys): the hashes of the lines that each document loses."""
    spark = docs.sparkSession
    counts = cut(line_hashes(docs, min_chars).groupBy("h1", "h2")
                 .agg(F.count("*").alias("n"), F.max("id").alias("last")).filter(F.col("n") >= min_docs))
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts.count() // shard_keys))
    copies = _copies(counts, shards)
    parts: Column = F.lit(1)
    if copies:
        pairs = F.create_map(*(F.lit(x) for pair in copies.items() for x in pair))
        parts = F.coalesce(F.try_element_at(pairs, F.col("shard")), F.lit(1))
    probes = line_hashes(docs, min_chars).withColumn("shard", F.pmod("h1", F.lit(shards))).select(
        "shard", F.pmod(F.xxhash64("id"), parts).alias("salt"), "id", "h1", "h2",
        F.lit(None).cast(_INDEX).alias("index"))
    index = build_index(counts, shards).select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)).alias("salt"),
        F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
        "index")
    dealt = (probes.unionByName(index).repartition("shard", "salt")
             .sortWithinPartitions("shard", "salt", F.col("index").isNull()))
    return dealt.mapInArrow(_probe, "id long, key binary").groupBy("id").agg(F.collect_list("key").alias("keys"))


def _strip_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, dropped = [], [], []
            for text, keys in zip(batch.column("text"), batch.column("keys"), strict=True):
                text, lines, gone = text.as_py(), None, 0
                n = text.count("\n") + 1
                if keys.is_valid:
                    drop = set(keys.as_py())
                    lines = [x for x in text.split("\n") if _key(x, min_chars) not in drop]
                    text, gone = "\n".join(lines), n - len(lines)
                texts.append(text)
                total.append(n)
                dropped.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_text"])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, shard_keys: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept_text``."""
    doc_id = F.col(id_col).cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(_LOWEST)).alias("id"), text_or_empty(text_col).alias("text"))
    lost = repeated_lines(texts, min_chars, min_docs, shard_keys)
    rows = texts.join(lost, "id", "left").select(
        F.nullif("id", F.lit(_LOWEST)).alias("doc_id"), "text", "keys")
    return rows.mapInArrow(_strip_lines(min_chars), "doc_id long, n_lines long, n_dropped long, kept_text string")
