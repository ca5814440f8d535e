"""Cross-tokenizer alignment: how often do tokens of two vocabularies meet?

Each text is encoded by tokenizer A (byte-level BPE, over a space and the text; see
``byte_bpe``) and by tokenizer B (pieces with byte fallback, which adds that space itself). Byte offsets
at which tokens of both end cut a document into groups; every A token of a
group is linked to every B token of it. A pair of identifiers is scored by the number of
documents that hold it linked.

The index is inverted. Documents are numbered by (block, position); a block is
a run of at most 65,536 documents of one task, closed after ``block_links``
postings. Per pair and block there is one compressed bitmap of positions (sorted
16-bit numbers, or 8,192 bytes of bits where more than 4,096 are set):

1. the task encodes and aligns texts in batches, vectorised over a batch; the
   bitmaps of its batches are OR-merged when a block closes. Beside the bitmap of
   documents, a pair has multiplicity planes: plane j marks the documents whose
   number of links less one has bit j set, so most pairs have no plane;
2. popcounts give the document count of a pair and, weighted by plane, its link
   count. Blocks are disjoint, so popcounts add up: a map-side combined sum, to
   which the most frequent pair sends one row per task;
3. counts are joined to the bitmaps on the pair (a frequent pair has one row per
   block; a hot partition of this join is split by AQE), and per block the
   postings return scores: each bitmap adds its pair's count, times the plane's
   weight, to the sums of the documents it marks.

A group's links are counted by distinct identifiers and their multiplicities once it
has more than ``GROUP_LINKS``, so a long run without a common offset costs no more
than the distinct pairs in it.

Defined results: null and empty texts, and texts whose tokens' bytes differ from the
text under either tokenizer, have no tokens: zeros and an empty digest. Special-token
strings in a text are ordinary text. Repeated rows and null identifiers are documents
of their own, each counted; an empty table gives no row; extra columns are ignored.
Vocabulary files are read by the driver and sent to the workers (2 MB).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import byte_bpe
from .common import per_worker

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
#: postings after which a block closes, and bytes of text that are aligned at once
BLOCK_LINKS = 5_000_000
BATCH_BYTES = 1 << 20
GROUP_LINKS = 4096
POSITIONS = 1 << 16
_SPARSE = 4096
_PAIR_B = 1 << 20  # a pair is a * _PAIR_B + b
_DOCUMENTS = -1  # the plane that marks the documents themselves
_SEPARATORS = (",", "|", ";", "")


def byte_level_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the
    other bytes, in order, for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def joined(column: pa.Array | list[str], places: np.ndarray, n: np.ndarray) -> list[memoryview]:
    """Values of ``column`` at ``places``, joined for each run of ``n`` places."""
    column = pa.array(column, pa.large_binary()) if isinstance(column, list) else column
    taken = column.take(pa.array(places))
    stops = np.frombuffer(taken.buffers()[1], np.int64)[np.append(0, np.cumsum(n))].tolist()
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    return [data[start:stop] for start, stop in zip(stops, stops[1:], strict=False)]


class Vocabulary:
    """Bytes of the identifiers of a tokenizer, and its encoder of many texts."""

    def __init__(self, pieces: list[bytes], encode):
        self.pieces, self.encode = pieces, encode
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.column = pa.array(pieces, pa.large_binary())

    def texts(self, ids: list[np.ndarray]) -> list[memoryview]:
        """The bytes of the identifiers of each text."""
        return joined(self.column, np.concatenate(ids), np.array([len(x) for x in ids]))


def byte_level_vocabulary(file: bytes) -> Vocabulary:
    """Tokenizer A: its merges follow the order of its identifiers, so these are the ranks."""
    alphabet = byte_level_alphabet()
    vocabulary = json.loads(file)["model"]["vocab"]
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = bytes(map(alphabet.__getitem__, piece)) if all(c in alphabet for c in piece) else piece.encode()
    ranks = {pieces[i]: i for piece, i in vocabulary.items() if all(c in alphabet for c in piece)}
    for special in json.loads(file).get("added_tokens", ()):
        ranks.pop(special["content"].encode(), None)
    split, encoder = byte_bpe.splitter(), byte_bpe.Encoder(ranks)

    def encode(texts):
        return [np.frombuffer(ids, "<u4").astype(np.int64) for ids in encoder.encode([split(" " + t) for t in texts])]
    return Vocabulary(pieces, encode)


def piece_vocabulary(file: bytes) -> Vocabulary:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=file)

    def piece(i: int) -> bytes:
        text = processor.id_to_piece(i)
        if processor.is_byte(i):
            return bytes([int(re.fullmatch("<0x(..)>", text)[1], 16)])
        return text.replace("▁", " ").encode()
    return Vocabulary([piece(i) for i in range(processor.get_piece_size())],
                      lambda texts: [np.array(ids, np.int64) for ids in processor.encode(list(texts), num_threads=1)])


class Aligned:
    """Alignment of a batch of texts; the arrays have one entry per text, but
    ``pair``, ``text`` and ``links`` one per linked pair of a text."""

    def __init__(self, texts: list[str], a: Vocabulary, b: Vocabulary, strings: pa.Array | list[str]):
        n = len(texts)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        self.digests = [""] * n
        self.pair = self.text = self.links = np.zeros(0, np.int64)
        full = [i for i, t in enumerate(texts) if t]
        whole = [texts[i] for i in full]
        if not full:
            return
        ids_a, ids_b = a.encode(whole), b.encode(whole)
        kept = [(i, x, y) for i, t, x, y, of_x, of_y in zip(full, whole, ids_a, ids_b, a.texts(ids_a), b.texts(ids_b), strict=True)
                if (raw := b" " + t.encode()) == of_y and raw == of_x]
        if kept:
            self._align(np.array([i for i, _, _ in kept]), [x for _, x, _ in kept], [y for _, _, y in kept], a, b, strings)

    def _align(self, which, ids_a, ids_b, a, b, strings):
        flat_a, flat_b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)  # a text's end is one, so no group spans two texts
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        size_a, size_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
        text_of = np.repeat(np.arange(len(which)), n_a)[np.cumsum(size_a) - 1]  # of a group
        self.n_a[which], self.n_b[which] = n_a, n_b
        self.n_groups[which] = np.bincount(text_of, minlength=len(which))
        links = size_a * size_b
        self.n_links[which] = np.add.reduceat(links, np.searchsorted(text_of, np.arange(len(which))))
        self._digest(which, flat_a, flat_b, group_a, group_b, size_a, size_b, ends_a == common[group_a],
                     ends_b == common[group_b], n_a + n_b, strings)
        self._pairs(which, flat_a, flat_b, group_a, size_a, size_b, links, text_of)

    def _digest(self, which, flat_a, flat_b, group_a, group_b, size_a, size_b, last_a, last_b, n, strings):
        at_a = np.arange(len(flat_a)) + (np.cumsum(size_b) - size_b)[group_a]
        at_b = np.arange(len(flat_b)) + np.cumsum(size_a)[group_b]
        tokens = np.empty(len(flat_a) + len(flat_b), np.int64)
        wide = len(strings) // len(_SEPARATORS)
        tokens[at_a] = flat_a + wide * last_a
        tokens[at_b] = flat_b + 2 * wide * last_b
        stops = np.cumsum(n)
        tokens[stops - 1] += wide  # nothing follows the last token of a text
        for i, written in zip(which.tolist(), joined(strings, tokens, n), strict=True):
            self.digests[i] = hashlib.sha256(written).hexdigest()

    def _pairs(self, which, flat_a, flat_b, group_a, size_a, size_b, links, text_of):
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        small = links <= GROUP_LINKS
        of = np.flatnonzero(small[group_a])  # A tokens in groups that are expanded
        times = size_b[group_a[of]]
        from_b = np.repeat(first_b[group_a[of]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pairs = [np.repeat(flat_a[of], times) * _PAIR_B + flat_b[from_b]]
        texts, weights = [np.repeat(text_of[group_a[of]], times)], [np.ones(len(from_b), np.int64)]
        for g in np.flatnonzero(~small).tolist():
            x, n_x = np.unique(flat_a[first_a[g]:first_a[g] + size_a[g]], return_counts=True)
            y, n_y = np.unique(flat_b[first_b[g]:first_b[g] + size_b[g]], return_counts=True)
            pairs.append((x[:, None] * _PAIR_B + y).ravel())
            weights.append((n_x[:, None] * n_y).ravel())
            texts.append(np.full(len(x) * len(y), text_of[g]))
        # one number per (pair, text): pair < 2^37, text < 2^16
        key, weight = np.concatenate(pairs) * POSITIONS + which[np.concatenate(texts)], np.concatenate(weights)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        start = np.flatnonzero(np.diff(key, prepend=-1))
        self.links = np.add.reduceat(weight, start)
        self.pair, self.text = key[start] // POSITIONS, key[start] % POSITIONS


def bitmaps(positions: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Compressed bitmaps of runs of ``positions`` (ascending within a run)."""
    sizes = np.diff(starts, append=len(positions))
    if not (sizes > _SPARSE).any():
        offsets = 2 * np.append(starts, len(positions))
        return pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(positions.astype("<u2").tobytes())])
    out = []
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        run = positions[start:start + size]
        if size > _SPARSE:
            bits = np.zeros(POSITIONS, np.uint8)
            bits[run] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            out.append(run.astype("<u2").tobytes())
    return pa.array(out, pa.binary())


def marked(bits: bytes, n: int) -> np.ndarray:
    """The positions that a bitmap of popcount ``n`` marks."""
    if n > _SPARSE:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    return np.frombuffer(bits, "<u2").astype(np.int64)


class _Block:
    """Bitmaps of a block, gathered batch by batch."""

    def __init__(self, number: int):
        self.number, self.documents, self.postings, self.parts = number, 0, 0, []

    def add(self, found: Aligned, n: int) -> None:
        self.parts.append((found.pair * POSITIONS + found.text + self.documents, found.links))
        self.documents += n
        self.postings += len(found.pair)

    def rows(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if not self.postings:
            return
        key, links = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(key, kind="stable")  # OR: the batches' sorted positions become one run per pair
        key, more = key[order], links[order] - 1
        for plane in range(_DOCUMENTS, int(more.max()).bit_length()):
            mine = key if plane == _DOCUMENTS else key[(more >> plane) & 1 == 1]
            if not len(mine):
                continue
            pair = mine // POSITIONS
            starts = np.flatnonzero(np.diff(pair, prepend=-1))
            pair, sizes = pair[starts], np.diff(starts, append=len(mine))
            maps = bitmaps(mine % POSITIONS, starts)
            for at in range(0, len(pair), 50_000):
                part = slice(at, at + 50_000)
                n = len(pair[part])
                yield _rows(kind, n, block=pa.array(np.full(n, self.number)), a=pa.array(pair[part] // _PAIR_B),
                            b=pa.array(pair[part] % _PAIR_B), plane=pa.array(np.full(n, plane)),
                            n=pa.array(sizes[part]), bits=maps.slice(at, n))


_COLUMNS = {"block": pa.int64(), "position": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
            "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int64(), "b": pa.int64(), "plane": pa.int64(),
            "n": pa.int64(), "bits": pa.binary()}


def _rows(kind: pa.DataType, size: int, /, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"doc_id": kind, **_COLUMNS}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, t)) for c, t in kinds.items()], names=list(kinds))


def _index(tokenizers, block_links: int, batch_bytes: int):
    """(doc_id, text) -> a row per document, and a row per pair, block and plane."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b, strings = tokenizers()
        number = TaskContext.get().partitionId() << 31
        block = _Block(number)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(texts):
                base = sizes[at - 1] if at else 0
                stop = min(max(at + 1, int(np.searchsorted(sizes, base + batch_bytes, "right"))), at + POSITIONS)
                n = stop - at
                if block.documents + n > POSITIONS or block.postings >= block_links:
                    yield from block.rows(ids.type)
                    block = _Block(block.number + 1)
                found = Aligned(texts[at:stop].to_pylist(), a, b, strings)
                yield _rows(ids.type, n, doc_id=ids.slice(at, n), block=pa.array(np.full(n, block.number)),
                            position=pa.array(np.arange(block.documents, block.documents + n)), n_a=pa.array(found.n_a),
                            n_b=pa.array(found.n_b), n_groups=pa.array(found.n_groups), n_links=pa.array(found.n_links),
                            groups_sha256=pa.array(found.digests, pa.string()))
                block.add(found, n)
                at = stop
        yield from block.rows(ids.type if block.documents else pa.int64())
    return run


def _tokenizers(spark: SparkSession, path_a: str, path_b: str):
    """Loads both tokenizers once per worker, from bytes sent by the driver."""
    def content(path: str) -> bytes:
        with open(path, "rb") as file:
            return file.read()
    sent = spark.sparkContext.broadcast((content(path_a), content(path_b)))

    def load():
        a, b = byte_level_vocabulary(sent.value[0]), piece_vocabulary(sent.value[1])
        wide = max(len(a.pieces), len(b.pieces))
        # token, separator behind it: "," within a side, "|" and ";" at its end, "" at the end of the text
        return a, b, pa.array([f"{i}{s}".encode() for s in _SEPARATORS for i in range(wide)], pa.large_binary())
    return lambda: per_worker(("alignment", path_a, path_b), load)


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str = VOCABULARY_A,
                    vocabulary_b: str = VOCABULARY_B, block_links: int = BLOCK_LINKS,
                    batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, postings), both read from one table in the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(
        f"{c} {'string' if t == pa.string() else 'binary' if t == pa.binary() else 'long'}" for c, t in _COLUMNS.items())
    path = scratch_path(spark, "alignment")
    texts.mapInArrow(_index(_tokenizers(spark, vocabulary_a, vocabulary_b), block_links, batch_bytes), schema).write.parquet(path)
    table = spark.read.parquet(path)
    documents = table.filter("a is null").select("doc_id", *list(_COLUMNS)[:7])
    return documents, table.filter("a is not null").select("block", "a", "b", "plane", "n", "bits")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): documents and links of each pair;
    ``best`` where no pair of the same A identifier has more documents."""
    weight = F.expr("shiftleft(1L, cast(greatest(plane, 0) as int))")
    counts = postings.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") == _DOCUMENTS, F.col("n"))).alias("n_docs"),
                                            F.sum(F.col("n") * weight).alias("n_links"))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("_most"))
    return counts.join(most, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("_most")).alias("best"))


def _scores(table: pa.Table) -> pa.Table:
    """The sums of one block's documents."""
    sums, best = np.zeros(POSITIONS, np.int64), np.zeros(POSITIONS, np.int64)
    for part in table.to_batches(max_chunksize=100_000):
        n, count = part.column("n").to_numpy(), part.column("n_docs").to_numpy()
        plane, is_best = part.column("plane").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)
        weight = np.left_shift(np.int64(1), np.maximum(plane, 0))
        places = [marked(bits, k) for bits, k in zip(part.column("bits").to_pylist(), n.tolist(), strict=True)]
        at = np.concatenate(places)
        np.add.at(sums, at, np.repeat(weight * count, n))
        np.add.at(best, at, np.repeat(weight * is_best, n))
    at = np.flatnonzero(sums)
    return pa.table({"block": pa.array(np.full(len(at), table.column("block")[0].as_py())), "position": pa.array(at),
                     "n_best": pa.array(best[at]), "count_sum": pa.array(sums[at])})


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    documents, postings = index_documents(docs, id_col, text_col, **options)
    counts = pair_counts(postings).select("a", "b", "n_docs", "best")
    scored = (postings.join(counts, ["a", "b"]).select("block", "plane", "n", "bits", "n_docs", "best").groupBy("block")
              .applyInArrow(_scores, "block long, position long, n_best long, count_sum long"))
    zero = F.lit(0).cast("long")
    return documents.join(scored, ["block", "position"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
