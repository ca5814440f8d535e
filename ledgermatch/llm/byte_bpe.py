"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is split into pre-tokens (every match of ``PATTERN``), and the bytes of
each are merged by rank. Texts of at most ``chunk`` characters are
one chunk and are encoded where they are. Longer ones:

1. are cut into windows of ``chunk`` characters plus ``overlap`` characters of the
   next one. Windows are dealt over the tasks and pre-tokenised at once, each from
   its first character on, which may lie within a pre-token;
2. are stitched where boundaries resynchronise: the first position after a
   seam at which both the window before and the window behind have a
   boundary. A match depends on nothing before it, so from there on both
   windows split alike. A boundary counts as the earlier window's only if the
   ``REACH`` characters behind it, all that the pattern looks at, lie in the window;
3. each window then encodes the pre-tokens from its own seam to the next one,
   and the identifiers of a document are joined in order.

A document in which some seam has no common boundary in the overlap (a
run of one kind of character may be longer) goes round again with windows and
overlaps four times as long, at last in one window: no document is given up.

Merging takes the pair of least rank, the leftmost of equal ones, until no pair
has a rank. A batch's distinct new pre-tokens are merged at once, a row each of a matrix
that loses one column per step; long pre-tokens keep their pairs in a heap. Each
worker remembers the identifiers of ``REMEMBERED`` distinct pre-tokens at most.
Decoding joins the bytes of the identifiers.

Defined results: a null or empty text has no identifiers; special-token
strings in a text are ordinary text; repeated rows and null identifiers each give a
row; an empty table gives no row; extra columns are ignored. The rank file is
read by the driver and sent to the workers (a vocabulary, under a megabyte).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, per_worker, text_or_empty

# fixed values: the public tokenizers' split pattern, and the rank file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: characters behind the end of a match that can decide it ("'" is a match of its own only if no "ll" follows)
REACH = 2
# fixed values: letters and digits that were unassigned in Unicode 16, whose classes the rank files' library uses
NEWER = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 "
    "\uab6c-\uab6d \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a "
    "\U00011db0-\U00011ddb \U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 "
    "\U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda "
    "\U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 "
    "\U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff "
    "\U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 "
    "\U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 "
    "\U0003d000-\U0003fc3f").replace(" ", "")
#: distinct pre-tokens whose identifiers a worker remembers, and characters that it encodes at once
REMEMBERED = 200_000
BATCH_CHARS = 1 << 18
_NO_RANK = 1 << 60
_LOW = 0x250  # Latin letters; none of them is in NEWER
_MATRIX_TO, _HEAP_FROM = 32, 80


def splitter() -> Callable[[str, int], list[str]]:
    """``split(text, start)``: the pre-tokens of ``text`` from ``start`` on."""
    def make():
        import regex

        plain, low = regex.compile(PATTERN).findall, _low_splitter()
        known = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\s[\p{L}\p{N}--[@]]]").replace(r" ?\p{L}+", r" ?[\p{L}--[@]]+")
        known = known.replace(r" ?\p{N}+", r" ?[\p{N}--[@]]+").replace("@", NEWER)
        exact = regex.compile("(?V1)" + known).findall
        newer = "".join(c for c in re.findall(r".(?:-.)?", NEWER) if c < "\U00010000")
        maybe = re.compile(f"[{newer}\U00010000-\U0010ffff]").search
        high = re.compile(f"[^\0-{chr(_LOW - 1)}]").search
        return lambda text, start=0: (low if text.isascii() or not high(text) else plain if not maybe(text) else exact)(text, start)
    return per_worker("byte_bpe split", make)


def _low_splitter() -> Callable[[str, int], list[str]]:
    """The same for texts of characters below ``_LOW`` alone, whose classes are written out for the faster ``re``."""
    import regex

    letter, digit, space = ("".join(f"\\u{i:04x}" for i in range(_LOW) if regex.fullmatch(kind, chr(i)))
                            for kind in (r"\p{L}", r"\p{N}", r"\s"))
    known = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{digit}]").replace(r"\p{L}", f"[{letter}]")
    known = known.replace(r"\p{N}", f"[{digit}]").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")
    return re.compile(known).findall


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Identifiers of one pre-token."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) >= _HEAP_FROM:
        return _merge_by_heap(piece, ranks)
    rank = ranks.get
    cuts = list(range(len(piece) + 1))
    pairs = [rank(piece[i:i + 2], _NO_RANK) for i in range(len(piece) - 1)]  # of part i with part i + 1
    while pairs and (least := min(pairs)) < _NO_RANK:
        i = pairs.index(least)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(piece[cuts[i]:cuts[i + 2]], _NO_RANK)
        if i:
            pairs[i - 1] = rank(piece[cuts[i - 1]:cuts[i + 1]], _NO_RANK)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def _merge_by_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long pre-tokens, in n log n steps: parts are a linked list by start."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # start of the next part (n: none), of the one before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if j < 0 or j >= n or after[j] != end:  # one of the two parts has changed since
            continue
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i:after[end]])) is not None:
                heappush(heap, (r, i, after[end]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:end])) is not None:
            heappush(heap, (r, h, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Merger:
    """Merges many short pre-tokens at once. Identifiers are the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {ranks[p[:i]] << 32 | ranks[p[i:]]: rank for p, rank in ranks.items()
                 for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)
        self.of_bytes = self._rank(self.of_byte[:, None], self.of_byte)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; of none where a side is missing (-1) or the pair has none."""
        pair = left << 32 | right
        if not len(self.pairs):
            return np.full(pair.shape, _NO_RANK)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (right >= 0), self.merged[at], _NO_RANK)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The identifiers of each piece, little-endian 32-bit."""
        out = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(sizes, kind="stable")
        at = np.searchsorted(sizes[order], [0, 5, 9, 13, 19, _MATRIX_TO + 1])  # rows of like length share a matrix
        for start, stop in zip(at, at[1:], strict=False):
            if stop > start:
                self._merge_rows([pieces[i] for i in order[start:stop]], order[start:stop], out)
        for i in order[at[-1]:].tolist():
            out[i] = np.array(merge(pieces[i], self.ranks), "<u4").tobytes()
        return out

    def _merge_rows(self, pieces: list[bytes], number: np.ndarray, out: list[bytes]) -> None:
        sizes = np.array([len(p) for p in pieces])
        there = np.arange(sizes.max()) < sizes[:, None]
        tokens, raw = np.full(there.shape, -1, np.int64), np.zeros(there.shape, np.uint8)
        raw[there] = np.frombuffer(b"".join(pieces), np.uint8)
        tokens[there] = self.of_byte[raw[there]]
        ranks = np.where(there[:, 1:], self.of_bytes[raw[:, :-1], raw[:, 1:]], _NO_RANK)
        while ranks.shape[1]:
            i = ranks.argmin(1)
            least = ranks[np.arange(len(i)), i]
            go = least < _NO_RANK
            self._done(tokens[~go], number[~go], out)
            tokens, ranks, number, i, least = tokens[go], ranks[go], number[go], i[go, None], least[go]
            row = np.arange(len(number))
            tokens[row, i[:, 0]] = least  # parts i and i + 1 become one, and every row a column shorter
            column = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, column + (column > i), 1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= i), 1)
            i = i[:, 0]
            for on, side in ((i < ranks.shape[1], i), (i > 0, i - 1)):  # the pairs with the new part
                r, c = row[on], side[on]
                ranks[r, c] = self._rank(tokens[r, c], tokens[r, c + 1])
        self._done(tokens, number, out)

    def _done(self, tokens: np.ndarray, number: np.ndarray, out: list[bytes]) -> None:
        there = tokens >= 0
        ids, stops = tokens[there].astype("<u4").tobytes(), np.cumsum(4 * there.sum(1)).tolist()
        for i, start, stop in zip(number.tolist(), [0, *stops], stops, strict=False):
            out[i] = ids[start:stop]


class Encoder:
    """Identifiers of lists of pre-tokens, remembered by pre-token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.merger, self.known = ranks, Merger(ranks), {}

    def encode(self, lists: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, n = self.known, [len(pieces) for pieces in lists]
        coded = pa.array(chain.from_iterable(lists), pa.large_string(), size=sum(n)).dictionary_encode()
        seen = coded.dictionary.to_pylist()
        new = [p for p in seen if p not in known]
        known.update(zip(new, self._new(new), strict=True))
        # each distinct pre-token is looked up once, its identifiers are then taken for every time that it comes
        ids = pa.array(map(known.__getitem__, seen), pa.large_binary(), size=len(seen)).take(coded.indices)
        stops = np.frombuffer(ids.buffers()[1], np.int64)[np.cumsum([0, *n])].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        out = [bytes(data[start:stop]) for start, stop in zip(stops, stops[1:], strict=False)]
        for piece in new:
            if len(piece) > _MATRIX_TO:
                del known[piece]
        return out

    def _new(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        out = [None if (r := self.ranks.get(p)) is None else np.uint32(r).tobytes() for p in raw]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.merger.merge([raw[i] for i in rest]), strict=True):
            out[i] = ids
        return out


def in_parts(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of neighbours of at most ``most`` in all, or of one."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


class Ranks:
    """A rank file, sent to the workers once."""

    def __init__(self, spark: SparkSession, path: str):
        self.key = path
        with open(path, "rb") as file:
            self.sent = spark.sparkContext.broadcast(file.read())

    def table(self) -> dict[bytes, int]:
        return per_worker(("byte_bpe ranks", self.key), lambda: {
            base64.b64decode(a): int(b) for a, b in map(bytes.split, self.sent.value.splitlines()) if a})

    def encoder(self) -> Encoder:
        return per_worker(("byte_bpe encoder", self.key), lambda: Encoder(self.table()))

    def pieces(self) -> list[bytes]:
        def by_id():
            out = [b""] * (max(self.table().values(), default=-1) + 1)
            for piece, i in self.table().items():
                out[i] = piece
            return out
        return per_worker(("byte_bpe pieces", self.key), by_id)


Batches = Iterator[pa.RecordBatch]


def _bytes_of(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coded(keys: dict[str, pa.Array], ids: list[bytes], pieces: list[bytes] | None) -> pa.RecordBatch:
    """``keys``, the identifiers and, given the pieces, the bytes that they stand for."""
    columns = {**keys, "ids": pa.array(ids, pa.binary())}
    if pieces is not None:
        columns["decoded"] = pa.array([_bytes_of(x, pieces) for x in ids], pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _encode_whole(ranks: Ranks, decode: bool):
    """A batch is read, encoded and handed on ``BATCH_CHARS`` characters at a time."""
    def run(batches: Batches) -> Batches:
        split, encoder, pieces = splitter(), ranks.encoder(), ranks.pieces() if decode else None
        for batch in batches:
            for part in in_parts(pc.utf8_length(batch.column(1)).to_pylist(), BATCH_CHARS):
                rows = batch.slice(part.start, part.stop - part.start)
                yield _coded({"doc_id": rows.column(0)}, encoder.encode(
                    [split(t) for t in rows.column(1).to_pylist()]), pieces)
    return run


def _windows(chunk: int, overlap: int):
    """(_row, text) -> its windows, a few at a time."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                for k, at in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([k], pa.int64()), pa.array([at + chunk >= len(text)]),
                         pa.array([text[at:at + chunk + overlap]], pa.string())], names=["_row", "k", "last", "window"])
    return run


def _boundaries(chunk: int, overlap: int):
    """Adds the boundaries behind the window's first character (``head``) and
    behind the next window's (``tail``), each counted from that character."""
    def run(batches: Batches) -> Batches:
        split = splitter()
        for batch in batches:
            heads, tails = [], []
            for value, last in zip(batch.column("window"), batch.column("last").to_pylist(), strict=True):
                text = value.as_py()
                ends = np.cumsum([0, *map(len, split(text))])
                sure = ends[ends <= len(text) - (0 if last else REACH)]
                heads.append(ends[ends < overlap])
                tails.append(sure[(sure >= chunk) & (sure < chunk + overlap)] - chunk)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, kind), pa.array(tails, kind)],
                                             names=[*batch.schema.names, "head", "tail"])
    return run


def _encode_windows(ranks: Ranks, decode: bool):
    """(_row, k, window, start, stop) -> the identifiers of its pre-tokens from start to stop."""
    def run(batches: Batches) -> Batches:
        split, encoder, known = splitter(), ranks.encoder(), ranks.pieces() if decode else None
        for batch in batches:
            out = []
            for value, start, stop in zip(*(batch.column(c) for c in ("window", "start", "stop")), strict=True):
                pieces = split(value.as_py(), start.as_py())
                ends = start.as_py() + np.cumsum([0, *map(len, pieces)])
                out += encoder.encode([pieces[:int(np.searchsorted(ends, stop.as_py()))]])
            yield _coded({"_row": batch.column("_row"), "k": batch.column("k")}, out, known)
    return run


def _stitched(texts: DataFrame, ranks: Ranks, chunk: int, overlap: int, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """((_row, ids) of the documents whose windows all resynchronise, the ``_row`` of the others)."""
    parts = (texts.mapInArrow(_windows(chunk, overlap), "_row long, k long, last boolean, window string")
             .repartition("_row", "k"))
    split = cut(parts.mapInArrow(_boundaries(chunk, overlap),
                                 "_row long, k long, last boolean, window string, head array<long>, tail array<long>"))
    order = Window.partitionBy("_row").orderBy("k")
    common = F.array_intersect("tail", F.lead("head").over(order))
    seams = split.select("_row", "k", "last", F.array_min(common).alias("seam"))
    seams = cut(seams.select("_row", "k", "last", "seam", F.coalesce(F.lag("seam").over(order), F.lit(0)).alias("start")))
    open_rows = seams.filter("not last and seam is null").select("_row").distinct()
    spans = seams.select("_row", "k", "start", F.when(F.col("last"), F.lit(1 << 62)).otherwise(
        F.col("seam") + chunk).alias("stop")).join(open_rows, "_row", "left_anti")
    ids = split.select("_row", "k", "window").join(spans, ["_row", "k"]).mapInArrow(
        _encode_windows(ranks, "decoded" in columns), ", ".join(["_row long, k long", *(f"{c} binary" for c in columns)]))
    return ids.groupBy("_row").agg(*(F.expr(f"listagg({c}) within group (order by k)").alias(c) for c in columns)), open_rows


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
                     chunk: int = 1 << 15, overlap: int = 1 << 9, decode: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``ids`` (identifiers as
    little-endian unsigned 32-bit integers) and, with ``decode``, ``decoded``: the bytes
    of the identifiers, joined by the task that has them at hand."""
    table, columns = Ranks(docs.sparkSession, ranks), ["ids", "decoded"] if decode else ["ids"]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    short = F.length("text") <= chunk
    out = texts.filter(short).mapInArrow(_encode_whole(table, decode), ", ".join(
        [f"doc_id {kind}", *(f"{c} binary" for c in columns)]))
    long = cut(texts.filter(~short).withColumn("_row", F.monotonically_increasing_id()))
    left = long.select("_row", "text")
    while not left.isEmpty():
        ids, open_rows = _stitched(left, table, chunk, overlap, columns)
        out = out.unionByName(long.select("_row", "doc_id").join(ids, "_row").select("doc_id", *columns))
        left, chunk, overlap = cut(left.join(open_rows, "_row")), 4 * chunk, 4 * overlap
    return out


def decoded(ids: Column, ranks: Ranks) -> Column:
    """The bytes of stored identifiers, joined."""
    @F.pandas_udf("binary")
    def join(column: pd.Series) -> pd.Series:
        pieces = ranks.pieces()
        return column.map(lambda x: None if x is None else _bytes_of(x, pieces))
    return join(ids)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, **options) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the bytes that the identifiers stand for."""
    return encode_documents(docs, id_col, text_col, ranks, decode=True, **options)
