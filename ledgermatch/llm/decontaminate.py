"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and their blanks are collapsed. An item of
m characters has an error budget of k = floor(m x ``error_rate``) edits and is
split into k + 1 pieces: an occurrence with at most k edits leaves at least one
piece intact. All pieces of a block of items are searched exactly in every
whole text by one Aho-Corasick automaton. A hit climbs the tree of pieces:
neighbouring pieces are joined pairwise, and a join of n pieces must occur
around the hit with fewer than n edits (if both halves had more than their
share, so had the whole). The root is the whole item with its whole budget.
Distances come from Myers' bit-parallel algorithm. An item too short for a budget
of one edit is one piece and must stand as whole words.

The test set is read in blocks of bounded text size; each block is sent to the
tasks and applied to all rows, so a larger test set means more blocks, not a
larger broadcast. No shuffle is needed.

Defined results: a null text is empty and has no match; items that are null or
blank occur nowhere; items of every other length are searched; items with
equal text are all reported; repeated rows each give a row; extra columns are
ignored, or kept by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_worker, text_or_empty

MATCH = "array<struct<item_id:long,distance:long,start:long,stop:long>>"
_MATCH = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "distance", "start", "stop")]))


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern_bits: dict[str, int], length: int, text: str, most: int) -> tuple[int, int] | None:
    """(least distance, end) over all substrings of ``text``, if at most
    ``most``; the bits of column vectors are those of one integer."""
    mask, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best, end = mask, 0, length, most + 1, -1
    get = pattern_bits.get
    for i, c in enumerate(text):
        equal = get(c, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus)
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up <<= 1
        down <<= 1
        plus = (down | ~(vertical | up)) & mask
        minus = up & vertical & mask
        if score < best:
            best, end = score, i + 1
    return (best, end) if end >= 0 else None


class Node:
    """A join of neighbouring pieces: text span [lo, hi) of its item, and its
    budget, one less than its pieces."""

    __slots__ = ("bits", "budget", "hi", "lo", "parent", "text")

    def __init__(self, text: str, lo: int, hi: int, pieces: int):
        self.text, self.lo, self.hi, self.budget = text[lo:hi], lo, hi, pieces - 1
        self.parent: Node | None = None
        self.bits: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def occurs(self, text: str, at: int) -> tuple[int, int, int] | None:
        """(distance, start bound, end) near the place where the node would
        begin at ``at`` but for its edits."""
        lo = max(0, at - self.budget)
        found = myers(self.bits, len(self.text), text[lo:at + len(self.text) + self.budget], self.budget)
        return None if found is None else (found[0], lo, lo + found[1])


def piece_tree(text: str, budget: int) -> list[Node]:
    """The leaves (pieces) of an item; each knows its parent."""
    n = budget + 1
    level = [(Node(text, len(text) * i // n, len(text) * (i + 1) // n, 1), 1) for i in range(n)]
    leaves = [node for node, _ in level]
    while len(level) > 1:
        joined = []
        for i in range(0, len(level) - 1, 2):
            (a, x), (b, y) = level[i], level[i + 1]
            a.parent = b.parent = Node(text, a.lo, b.hi, x + y)
            joined.append((a.parent, x + y))
        level = joined + level[len(level) - len(level) % 2:]
    return leaves


def whole_words(text: str, start: int, stop: int) -> bool:
    """Whether no word goes on at either end of the span."""
    return not (text[start - 1:start].isalnum() or text[stop:stop + 1].isalnum())


class Matcher:
    """The automaton over all pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        by_piece: dict[str, list[tuple[int, Node]]] = {}
        for number, (_, text) in enumerate(items):
            for leaf in piece_tree(text, int(len(text) * error_rate)) if text else ():
                by_piece.setdefault(leaf.text, []).append((number, leaf))
        self.items, self.automaton = items, None
        if by_piece:
            self.automaton = ahocorasick.Automaton()
            for piece, owners in by_piece.items():
                self.automaton.add_word(piece, (len(piece), owners))
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        """The closest occurrence of each item in a normalised text."""
        best: dict[int, tuple[int, int, int]] = {}
        if self.automaton is None:
            return []
        rejected: set[tuple[int, int]] = set()
        for last, (length, owners) in self.automaton.iter(text):
            for number, leaf in owners:
                if number in best and best[number][0] == 0:
                    continue
                if leaf.parent is None and not whole_words(text, last + 1 - length, last + 1):
                    continue
                start = last + 1 - length - leaf.lo  # where the item would begin
                node, found = leaf, (0, last + 1 - length, last + 1)
                while node.parent is not None and found is not None:
                    node = node.parent
                    key = (id(node), start)
                    if key in rejected:
                        found = None
                    else:
                        found = node.occurs(text, start + node.lo)
                        if found is None:
                            rejected.add(key)
                if found is not None and (number not in best or found < best[number]):
                    best[number] = found
        return [{"item_id": self.items[n][0], "distance": d, "start": s, "stop": e}
                for n, (d, s, e) in sorted(best.items())]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The normalised test items in blocks of at most ``block_chars`` characters."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    for row in rows.toLocalIterator():
        text = normalise(row["t"])
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["i"], text))
        size += len(text)
    if block:
        yield block


def _match_column(text: Column, items: list[tuple[int, str]], error_rate: float) -> Column:
    name = ("benchmark", hash(tuple(items)), error_rate)

    @F.arrow_udf(MATCH)
    def find(texts: pa.Array) -> pa.Array:
        matcher = per_worker(name, lambda: Matcher(items, error_rate))
        return pa.array([matcher.matches(normalise(t.as_py() or "")) for t in texts], _MATCH)

    return find(text)


def match_column(text: Column, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 error_rate: float = 0.1, block_chars: int = 4_000_000) -> Column:
    """Array of (item, distance, start, stop) per text: the closest occurrence
    of every item found within its budget. ``start`` is a lower bound of the
    place, ``stop`` its end, in the normalised text."""
    blocks = [_match_column(text, block, error_rate)
              for block in item_blocks(items, id_col, text_col, block_chars)]
    return F.concat(*blocks) if blocks else F.array().cast(MATCH)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``matches``."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       match_column(text_or_empty(text_col), items, **options).alias("matches"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with their columns."""
    return docs.filter(F.size(match_column(text_or_empty(text_col), items, **options)) == 0)
