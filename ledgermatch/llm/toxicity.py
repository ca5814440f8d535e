"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is itself plus its character n-grams, each hashed to a bucket with an
embedding; a text is the average over its words (and a few empty ones, which
steady short texts) of their averaged buckets, and a linear softmax over that average gives two class probabilities. Embeddings
and softmax are trained jointly, by Adam in numpy, on a bounded sample of
labelled rows: at most ``max_rows`` of them and ``max_chars`` characters, the first by a
hash of their identifier, so the sample does not depend on file order. The bounds
are parameters; scoring covers every whole text. Training runs in one Spark task: the sample
and its bags never pass through the driver, which receives the folded weights (half
a megabyte). Steps, batch, rate, decay and the least number of texts that hold a trained
bucket are fixed values, the same for every size of sample.

The class scores are linear in the average, so the trained model folds into
one number per bucket (the logit's weight); only these are sent to the tasks.

Defined results: a null or blank text scores as the average of no words (the
model's bias); labels that are null are not learned from; a document that is
labelled twice counts twice; without labels of both classes every score is the
share of toxic labels (0 without labels); repeated rows each give a row; extra
columns are ignored, or kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
#: words without a bucket that join every average: a text of few words moves less
EMPTY_WORDS = 16
CHUNK_CHARS = 500_000  # texts are taken apart in chunks of about this size
_PUNCTUATION = ".,;:!?\"'()[]{}<>*_-…«»„“”¡¿"


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(_PUNCTUATION) for x in text.lower().split()) if w]


def _bucket(h: np.ndarray) -> np.ndarray:
    """Mixes 64-bit polynomial hashes down to bucket numbers."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int32)


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) pairs: each word's own bucket and those of its
    n-grams, word ends marked, for all words at once."""
    base = np.uint64(1_000_003)
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(len(codes)) - starts[owner]
    powers = np.cumprod(np.full(int(sizes.max()) if len(sizes) else 1, base, np.uint64))
    whole = np.add.reduceat(codes * powers[inside], starts) if len(words) else np.zeros(0, np.uint64)
    owners, buckets = [np.arange(len(words))], [_bucket(whole)]
    for n in GRAMS:
        h = np.full(max(len(codes) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = h * base + codes[k:k + len(h)]
        fits = np.flatnonzero(inside[:len(h)] + n <= sizes[owner[:len(h)]])
        owners.append(owner[fits])
        buckets.append(_bucket(h[fits]))
    return np.concatenate(owners), np.concatenate(buckets)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _tokens(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, text number of each token, word number of each token)."""
    number: dict[str, int] = {}
    word, sizes = [], []
    for text in texts:
        found = words_of(text)
        sizes.append(len(found))
        word.extend([number.setdefault(w, len(number)) for w in found])
    return list(number), np.repeat(np.arange(len(texts)), sizes), np.array(word, np.int64)


def bags_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text: the weight of a bucket in the average."""
    for chunk in _chunks(texts):
        words, text, word = _tokens(chunk)
        pair, times = np.unique(text * len(words) + word, return_counts=True)  # (text, word) and its count
        text, word = pair // max(len(words), 1), pair % max(len(words), 1)
        share = times / (np.bincount(text, times, len(chunk))[text] + EMPTY_WORDS)
        owner, bucket = word_buckets(words)
        bucket = bucket[np.argsort(owner, kind="stable")]
        n = np.bincount(owner, minlength=len(words))
        at = np.arange(n[word].sum()) + np.repeat((np.cumsum(n) - n)[word] - (np.cumsum(n[word]) - n[word]), n[word])
        cell, place = np.unique(np.repeat(text, n[word]) * BUCKETS + bucket[at], return_inverse=True)
        weight = np.bincount(place, np.repeat(share / n[word], n[word])).astype(np.float32)
        edges = np.searchsorted(cell, np.arange(len(chunk) + 1) * BUCKETS)
        for lo, hi in zip(edges, edges[1:], strict=False):
            yield (cell[lo:hi] % BUCKETS).astype(np.int32), weight[lo:hi].copy()


class Model:
    """Embeddings of the buckets that at least ``least_texts`` training texts
    hold, and a softmax. Other buckets have the zero vector. ``GAIN`` scales
    the average, whose entries are small, before the softmax."""

    GAIN = 300.0

    def __init__(self, texts: list[str], dim: int, least_texts: int, seed: int):
        rng = np.random.default_rng(seed)
        held = np.zeros(BUCKETS, np.int64)
        for bucket, _ in bags_of(texts):
            held[bucket] += 1
        self.used = np.flatnonzero(held >= least_texts)
        place = np.full(BUCKETS, -1, np.int32)
        place[self.used] = np.arange(len(self.used))
        self.bags = []
        for bucket, weight in bags_of(texts):  # a second pass, so that only trained buckets are held
            keep = place[bucket] >= 0
            self.bags.append((place[bucket[keep]], weight[keep]))
        self.params = [rng.normal(0, 0.01, (len(self.used), dim)), rng.normal(0, 0.5, (dim, 2)), np.zeros(2)]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params]
        self.steps = 0

    def fit(self, labels: np.ndarray, steps: int, batch: int, rate: float, decay: float, seed: int) -> None:
        """Adam on the cross entropy, with a linearly falling rate. The bias
        starts at the share of each class, the score of a text without words."""
        rng = np.random.default_rng(seed)
        self.params[2] += np.log(np.bincount(labels, minlength=2) / len(labels))
        waiting = np.zeros(0, np.int64)
        for step in range(steps):
            while len(waiting) < batch:  # the next epoch begins
                waiting = np.concatenate([waiting, rng.permutation(len(labels))])
            rows, waiting = waiting[:batch], waiting[batch:]
            self._update(self._gradients(self._entries(rows), labels[rows], decay), rate * (1 - step / steps))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row owner 0 .. n - 1, bucket, weight) of the entries of some texts."""
        chosen = [self.bags[r] for r in rows]
        return (np.repeat(np.arange(len(rows)), [len(b) for b, _ in chosen]),
                np.concatenate([b for b, _ in chosen]), np.concatenate([w for _, w in chosen])[:, None])

    def _gradients(self, entries, labels: np.ndarray, decay: float) -> list[np.ndarray]:
        owner, bucket, share = entries
        embed, weight, bias = self.params
        n = len(labels)
        mean = self._per(owner, embed[bucket] * share, n) * self.GAIN
        logits = mean @ weight + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), labels] -= 1
        p /= n
        to_mean = (p @ weight.T) * self.GAIN
        return [self._per(bucket, to_mean[owner] * share, len(embed)) + decay * embed, mean.T @ p, p.sum(axis=0)]

    def _update(self, gradients: list[np.ndarray], rate: float) -> None:
        self.steps += 1
        fast, slow = 1 - 0.9 ** self.steps, 1 - 0.99 ** self.steps
        for param, (m, v), g in zip(self.params, self.moments, gradients, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param -= rate * (m / fast) / (np.sqrt(v / slow) + 1e-8)

    @staticmethod
    def _per(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(group, values[:, j], n) for j in range(values.shape[1])], axis=1)

    def folded(self) -> tuple[np.ndarray, float]:
        """(logit weight per bucket, bias): the toxic logit less the other."""
        embed, weight, bias = self.params
        out = np.zeros(BUCKETS, np.float32)
        out[self.used] = self.GAIN * (embed @ (weight[:, 1] - weight[:, 0]))
        return out, float(bias[1] - bias[0])


def score_texts(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The probability of the toxic class for whole texts."""
    out = []
    for chunk in _chunks(texts):
        words, text, word = _tokens(chunk)
        owner, bucket = word_buckets(words)
        value = np.bincount(owner, weights[bucket], len(words)) / np.maximum(np.bincount(owner, minlength=len(words)), 1)
        n = np.bincount(text, minlength=len(chunk))
        logit = bias + np.bincount(text, value[word], len(chunk)) / (n + EMPTY_WORDS)
        out.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
    return np.concatenate([np.zeros(0), *out])


# ---- on Spark -------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str,
                    label_col: str) -> DataFrame:
    """(_h, _n, _t, _y) of at most ``max_rows`` labelled rows, the first by a hash of their identifier."""
    want = labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
    known = want.join(texts.select("_id"), "_id", "left_semi").withColumn("_h", F.md5(F.col("_id").cast("string")))
    chosen = known.orderBy("_h", "_id", "_y").limit(max_rows)
    rows = texts.join(F.broadcast(chosen), "_id")  # at most max_rows rows
    return rows.select("_h", F.length("_t").alias("_n"), "_t", "_y")


def within(batches: Iterator[pa.RecordBatch], max_chars: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels in order, without those that would pass ``max_chars`` in all."""
    texts, labels, size = [], [], 0
    for batch in batches:
        for n, text, label in zip(batch.column("_n").to_pylist(), batch.column("_t"), batch.column("_y").to_pylist(), strict=True):
            if size + n <= max_chars:
                texts.append(text.as_py())
                labels.append(label)
                size += n
    return texts, np.array(labels, np.int64)


def train(texts: list[str], labels: np.ndarray, dim: int = 4, steps: int = 1_000, batch: int = 64,
          rate: float = 0.03, decay: float = 1e-3, least_texts: int = 5, seed: int = 7) -> tuple[np.ndarray, float]:
    """(logit weight per bucket, bias). ``least_texts``: texts that must hold a
    bucket before it is trained."""
    if len(np.unique(labels)) < 2:
        share = np.clip(labels.mean() if len(labels) else 0.0, 1e-9, 1 - 1e-9)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    model = Model(texts, dim, least_texts, seed)
    model.fit(labels, steps, batch, rate, decay, seed)
    return model.folded()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = 8_000, max_chars: int = 40_000_000, **options) -> tuple[np.ndarray, float]:
    """Train, in one task, on a bounded sample of the labelled rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = train(*within(batches, max_chars), **options)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], names=["weights", "bias"])

    rows = labelled_sample(docs, labels, max_rows, id_col, text_col, label_col)
    order = ["_h", "_n", "_t", "_y"]  # the same sample gives the same model
    trained = rows.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "weights binary, bias double").collect()
    return (np.frombuffer(bytes(trained[0]["weights"]), np.float32), trained[0]["bias"]) if trained else train([], np.zeros(0, np.int64))


def score_column(text: Column, model: tuple[np.ndarray, float]) -> Column:
    weights, bias = model

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts([t.as_py() or "" for t in texts], weights, bias))

    return score(text)


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the identifiers that is never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    return docs.filter(score_column(text_or_empty(text_col), model) < threshold)
