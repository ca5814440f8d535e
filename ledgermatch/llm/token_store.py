"""Token counts by a separator scan of flat, unindexed token files.

Tokens of whole documents lie one after the other in flat files of 16-bit
little-endian identifiers, each document closed by the end-of-document
identifier. Files have no index: document boundaries are found by scanning.

1. Files are cut into blocks of equal size; each task range-reads a block and
   searches it for the separator with one vectorised comparison.
2. Blocks are stitched by a prefix scan per file: the number of separators
   before a block gives the ordinal of its first document, and the position of
   the last separator before it gives the tokens that the document already has
   (it may have begun many blocks earlier).
3. A document's count is the distance of its separator from the one before.

The writer keeps, apart from the files, the order of the documents in each
file; it is joined on (file, ordinal).

Defined results: a null or empty text has no tokens; special-token strings in
a text are ordinary text; tokens after the last separator of a file are one
more document; repeated rows and null identifiers each give a row; an empty
table gives no file and no row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_worker, text_or_empty
from .files import new_file, open_for_ranges, shared_folder, tasks_for

# fixed values: the public tokenizer's split pattern and its free identifier
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def load_tokenizer(ranks: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    def load():
        import tiktoken

        with open(ranks, "rb") as file:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        return tiktoken.Encoding(os.path.basename(ranks), pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return per_worker(("tokenizer", ranks), load)


def _write_tokens(folder: str, ranks: str, separator: int, file_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_tokenizer(ranks).encode_ordinary
        path = stream = None
        written = ordinal = 0
        for batch in batches:
            ids = batch.column(0)
            paths, ordinals = [], []
            for text in batch.column(1):
                if stream is None:
                    (path, stream), written, ordinal = new_file(folder, ".tokens"), 0, 0
                tokens = np.array([*encode(text.as_py()), separator], dtype="<u2")
                stream.write(tokens.tobytes())
                paths.append(path)
                ordinals.append(ordinal)
                written, ordinal = written + len(tokens), ordinal + 1
                if written >= file_tokens:
                    stream.close()
                    stream = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(ordinals, pa.int64()), ids], names=["path", "ordinal", "doc_id"])
        if stream is not None:
            stream.close()
    return run


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      ranks: str = RANKS, separator: int = END_OF_DOCUMENT, file_tokens: int = 1 << 24) -> DataFrame:
    """Tokenise and write ``docs``; returns (path, ordinal, doc_id), checkpointed."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return cut(texts.mapInArrow(_write_tokens(folder, ranks, separator, file_tokens),
                                f"path string, ordinal long, doc_id {kind}"))


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_for_ranges(path) as file:
                    size = file.size() // 2
                starts = np.arange(0, size, block_tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()),
                     pa.array(np.minimum(starts + block_tokens, size), pa.int64()),
                     pa.array(starts + block_tokens >= size, pa.bool_())], names=["path", "start", "stop", "last"])
    return run


def _scan(separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_for_ranges(path) as file:
                    tokens = np.frombuffer(file.read_at(2 * (stop - start), 2 * start), dtype="<u2")
                at = np.flatnonzero(tokens == separator) + start
                if last and tokens[-1] != separator:  # an unclosed document ends with the file
                    at = np.append(at, stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([start]), pa.array([len(at)], pa.int64()),
                     pa.array([int(at[-1]) if len(at) else None], pa.int64()), pa.array([at], pa.list_(pa.int64()))],
                    names=["path", "start", "found", "last", "at"])
    return run


def scan_token_files(files: DataFrame, separator: int = END_OF_DOCUMENT, block_tokens: int = 1 << 20) -> DataFrame:
    """(path, ordinal, n_tokens) of every document in the files named in column ``path``."""
    blocks = cut(files.select("path").mapInArrow(
        _blocks(block_tokens), "path string, start long, stop long, last boolean"))
    size = blocks.agg(F.sum(2 * (F.col("stop") - F.col("start")))).first()[0]
    found = cut(blocks.repartition(tasks_for(size), "path", "start").mapInArrow(
        _scan(separator), "path string, start long, found long, last long, at array<long>"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("path", "start", F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("before"),
                            F.coalesce(F.max("last").over(earlier), F.lit(-1).cast("long")).alias("edge"))
    ends = found.select("path", "start", "at").join(stitched, ["path", "start"])
    return ends.select("path", "before", "edge", "at", F.posexplode("at").alias("i", "end")).select(
        "path", (F.col("before") + F.col("i")).alias("ordinal"),
        (F.col("end") - F.when(F.col("i") > 0, F.get("at", F.col("i") - 1)).otherwise(F.col("edge")) - 1)
        .alias("n_tokens"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 1 << 20,
                 **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens`` (separator not
    counted), by writing flat token files and scanning them."""
    order = write_token_files(docs, shared_folder(docs.sparkSession, "tokens"), id_col, text_col, **options)
    counts = scan_token_files(order.select("path").distinct(), options.get("separator", END_OF_DOCUMENT), block_tokens)
    return order.join(counts, ["path", "ordinal"]).select("doc_id", "n_tokens")
