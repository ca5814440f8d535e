"""License scan: MinHash bands over overlapping text windows.

Every license text and statement is retrieved by bands and then verified by
exact containment of its shingles.

Texts (``TEXTS``, templates of five words or more) are cut into segments of at most
``SEGMENT`` five-word shingles. A document's shingles are hashed once; windows
start at every second shingle and have, for a segment of t shingles, the next
even size above t, so each run of t shingles lies in some window, where it is
at least half of the union. A window retrieves a segment if one of ``BANDS``
MinHash values agrees (bands of one row): at a similarity of one half or more
the chance to miss is at most 2^-12. Retrieved segments are verified by exact
containment of their shingles in the window; a template is found if its
segments' best windows hold at least ``least`` of its shingles.

Statements (``STATEMENTS``, forms of names that follow a lead, and templates of
fewer than five words) are sets of shingles of ``SHORT`` words (all their words, if
fewer). Their windows have as many words as the statement and start at any word.
``SHORT_BANDS`` bands of ``SHORT_ROWS`` rows: the threshold is a containment of 1, as one
word of ten is the version number, and equal sets agree in every band, so
none is missed, while a window at a similarity of one half is verified in vain with a
chance below one half. Verification asks for all shingles in their order, which
is the statement word for word; of those that begin at one word the longest counts, so
version 3 is not also "no version", and a name must follow a lead.

All of it is DataFrame expressions on the row that holds the text: nothing is
shuffled. A band can only agree if the window holds the shingle that is minimal for the
segment or statement in the band's first row, so only windows around such shingles
are built; the bands' result is the same.

``TEMPLATES`` are the functions' default; the registered query looks for all
of ``license_texts``.

Defined results: null and empty texts have no license; each row has the result of its own
text, also where identifiers repeat or lack; extra columns are ignored;
templates and statements without a word are refused.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_texts
from .common import text_or_empty

WORDS, SEGMENT, BANDS, LEAST = 5, 9, 12, 0.8
SHORT, SHORT_BANDS, SHORT_ROWS = 3, 2, 2
_MASK = (1 << 31) - 1

# fixed values: the statements that the functions look for by default
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files",
}


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _range(lo: Column, hi: Column, step: int = 1) -> Column:
    return F.when(hi >= lo, F.sequence(lo, hi, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _fixed(values: Sequence[str]) -> Column:
    """An array of SQL literals, parsed at once: building each literal takes longer."""
    return F.expr(f"array({', '.join(values)})")


def _numbers(entries: Mapping[int, Sequence[int]], key: Column) -> Column:
    """The numbers that ``entries`` gives for ``key``; none for another key."""
    known = F.expr("map({})".format(", ".join(
        f"{k}L, array({', '.join(map(str, sorted(set(ns))))})" for k, ns in entries.items())))
    return F.coalesce(F.try_element_at(known, key), F.array().cast("array<int>"))


def word_hashes(text: Column) -> Column:
    """Hashes of all words, in order (word: a run of ASCII letters and digits, lower-cased)."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(h: Column) -> Column:
    """Hashes of all runs of five words, in order."""
    return F.transform(_range(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WORDS))))


def short_shingles(h: Column) -> Column:
    """Hashes of all runs of ``SHORT`` words (of all words, if fewer), in order."""
    k = F.least(F.lit(SHORT), F.size(h))
    return F.transform(_range(F.lit(1), F.size(h) - k + 1), lambda i: F.xxhash64(F.slice(h, i, k)))


def _multipliers() -> list[int]:
    """Odd multipliers below 2^31, one per band: multiplying modulo 2^31
    permutes the 31-bit hashes."""
    out, x = [], 0x9E3779B9
    for _ in range(BANDS):
        x = (x * 1103515245 + 12345) & _MASK
        out.append(x | 1)
    return out


def _permuted(hashed: Column, multiplier: Column) -> Column:
    mask = F.lit(_MASK).cast("long")
    return (hashed.bitwiseAND(mask) * multiplier).bitwiseAND(mask)


def _wordings(templates: Mapping[str, str | Sequence[str]]) -> list[tuple[str, str]]:
    return [(name, x) for name, texts in templates.items() for x in ([texts] if isinstance(texts, str) else texts)]


class Statements:
    """What is found by bands over short windows: (name, text) pairs, and pairs that count after a lead only."""

    def __init__(self, spark: SparkSession, free: Sequence[tuple[str, str]], led: Sequence[tuple[str, str]],
                 leads: Sequence[str]):
        given = [*((n, t, "free") for n, t in free), *((n, t, "led") for n, t in led), *(("", t, "lead") for t in leads)]
        rows = spark.createDataFrame(given, "name string, text string, kind string").select(
            "name", "text", "kind", word_hashes(F.col("text")).alias("h")).select(
            "*", F.xxhash64("h").alias("whole"), short_shingles(F.col("h")).alias("s")).select(
            "*", *(self.signature(F.col("s"), F.size("h"), b).alias(f"band{b}") for b in range(SHORT_BANDS))
            ).collect()  # a fixed list
        if empty := [r["text"] for r in rows if not r["h"]]:
            raise ValueError(f"statements without a word: {empty}")
        self.leads = {r["whole"] for r in rows if r["kind"] == "lead"}
        self.lead_sizes = sorted({len(r["h"]) for r in rows if r["kind"] == "lead"})
        self.wholes: list[int] = []
        self.names: list[set[str]] = []
        self.free: set[int] = set()
        self.signatures: list[dict[int, list[int]]] = [{} for _ in range(SHORT_BANDS)]
        self.shapes: list[tuple[int, int]] = []
        self.anchors: dict[int, dict[int, list[int]]] = {}
        self.words: set[int] = set()
        numbers: dict[int, int] = {}
        for r in (r for r in rows if r["kind"] != "lead"):
            if r["whole"] not in numbers:
                numbers[r["whole"]] = len(self.wholes)
                self.wholes.append(r["whole"])
                self.names.append(set())
                self._anchor(r)
            n = numbers[r["whole"]]
            self.names[n].add(r["name"])
            if r["kind"] == "free":
                self.free.add(n)
            for b in range(SHORT_BANDS):
                self.signatures[b].setdefault(r[f"band{b}"], []).append(n)

    @staticmethod
    def rows_of(band: int) -> list[int]:
        return _multipliers()[band * SHORT_ROWS:(band + 1) * SHORT_ROWS]

    @classmethod
    def signature(cls, shingled: Column, size: Column, band: int) -> Column:
        """One band of a window: its length and the MinHash values of the band's rows."""
        def least(m: int) -> Column:
            return F.array_min(F.transform(shingled, lambda x: _permuted(x, F.lit(m).cast("long"))))
        return F.xxhash64(size, *map(least, cls.rows_of(band)))

    def _anchor(self, r) -> None:
        """Where the windows of a statement lie around the minimal shingle of each band's first row."""
        k = min(SHORT, len(r["h"]))
        for band in range(SHORT_BANDS):
            m = self.rows_of(band)[0]
            at = min(range(len(r["s"])), key=lambda j: ((r["s"][j] & _MASK) * m) & _MASK)
            shape = (at, len(r["h"]))
            if shape not in self.shapes:
                self.shapes.append(shape)
            self.words.add(r["h"][at])
            self.anchors.setdefault(k, {}).setdefault(r["s"][at], []).append(self.shapes.index(shape))

    def windows(self, h: Column) -> Column:
        """(start, size) of the windows that hold a minimal shingle at its place in some statement."""
        shapes = _fixed([f"named_struct('at', {at}, 'size', {size})" for at, size in self.shapes])

        def shingle(p: Column, k: int) -> Column:
            return F.xxhash64(*(F.get(h, p + j) for j in range(-1, k - 1)))

        def around(p: Column) -> Column:
            found = F.concat(*(_numbers(entries, shingle(p, k)) for k, entries in self.anchors.items()))
            return F.transform(found, lambda x: F.struct((p - F.get(shapes, x)["at"]).alias("start"),
                                                         F.get(shapes, x)["size"].alias("size")))
        places = F.filter(_range(F.lit(1), F.size(h)), lambda p: F.get(h, p - 1).isin(self.words) & reduce(
            lambda a, b: a | b, (shingle(p, k).isin(*entries) for k, entries in self.anchors.items())))
        return F.filter(F.array_distinct(F.flatten(F.transform(places, around))),
                        lambda w: (w["start"] >= 1) & (w["start"] + w["size"] - 1 <= F.size(h)))

    def verified(self, h: Column, w: Column) -> Column:
        """(start, size, n) of the statements that the bands retrieve for a window and that it holds."""
        wholes = _fixed([f"{x}L" for x in self.wholes])
        free = _fixed([str(n in self.free) for n in range(len(self.wholes))])
        led = F.exists(F.array(*map(F.lit, self.lead_sizes)), lambda k: (w["start"] > k) & F.xxhash64(
            F.slice(h, F.greatest(w["start"] - k, F.lit(1)), k)).isin(self.leads)) if self.leads else F.lit(False)

        def in_window(words: Column) -> Column:
            retrieved = _let(short_shingles(words), lambda s: F.array_distinct(F.concat(*(
                _numbers(of, self.signature(s, F.size(words), b)) for b, of in enumerate(self.signatures)))))
            return F.filter(retrieved, lambda n: (F.get(wholes, n) == F.xxhash64(words)) & (F.get(free, n) | led))
        return F.transform(_let(F.slice(h, w["start"], w["size"]), in_window),
                           lambda n: F.struct(w["start"].alias("start"), w["size"].alias("size"), n.alias("n")))

    def find(self, h: Column) -> Column:
        """Array of (license, containment): the longest statement at each word."""
        hits = _let(self.windows(h), lambda ws: F.flatten(F.transform(ws, lambda w: self.verified(h, w))))
        longest = _let(hits, lambda xs: F.filter(xs, lambda x: ~F.exists(
            xs, lambda y: (y["start"] == x["start"]) & (y["size"] > x["size"]))))
        names = sorted({n for ns in self.names for n in ns})
        owners = _fixed([f"array({', '.join(str(names.index(n)) for n in sorted(ns))})" for ns in self.names])
        found = F.array_distinct(F.flatten(F.transform(longest, lambda x: F.get(owners, x["n"]))))
        return F.transform(found, lambda n: F.struct(
            F.get(F.array(*map(F.lit, names)), n).alias("license"), F.lit(1.0).alias("containment")))


class Segments:
    """Segments of the templates, with their shingle hashes and MinHash values."""

    def __init__(self, spark: SparkSession, templates: Sequence[tuple[str, str]]):
        rows = spark.createDataFrame(list(enumerate(x for _, x in templates)), "t int, text string").select(
            "t", word_hashes(F.col("text")).alias("h")).select("t", shingles(F.col("h")).alias("h")).collect()  # the templates, a fixed list
        self.templates, self.hashes, self.totals = [], [], {}
        self.names = {t: name for t, (name, _) in enumerate(templates)}
        for r in rows:
            self.totals[r["t"]] = len(r["h"])
            pieces = -(-len(r["h"]) // SEGMENT)
            edges = [len(r["h"]) * i // pieces for i in range(pieces + 1)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                self.templates.append(r["t"])
                self.hashes.append(r["h"][lo:hi])

        self.numbers = range(len(self.hashes))
        self.widest = max(map(self.window, self.numbers))

    def window(self, n: int) -> int:
        size = len(self.hashes[n])
        return size + 1 + (size + 1) % 2

    def minhash(self, n: int, multiplier: int) -> int:
        return min(((h & _MASK) * multiplier) & _MASK for h in self.hashes[n])

    def minimal(self) -> list[int]:
        """The shingles that give some segment its MinHash in some band. A
        window without any of them agrees with no segment in any band."""
        return sorted({min(self.hashes[n], key=lambda h, m=m: ((h & _MASK) * m) & _MASK)
                       for n in self.numbers for m in _multipliers()})


def _retrieved(window: Column, multiplier: Column, segments: Segments) -> Column:
    """The numbers of the segments whose MinHash of one band is the window's."""
    values = [_permuted(F.get(window, F.lit(k)), multiplier) for k in range(segments.widest)]
    numbers = []
    for width in sorted({segments.window(n) for n in segments.numbers}):
        owners: dict[int, list[int]] = {}
        for n in segments.numbers:
            if segments.window(n) == width:
                for m in _multipliers():
                    owners.setdefault(segments.minhash(n, m), []).append(n)
        numbers.append(_let(F.least(*values[:width]), partial(_numbers, owners)))
    return F.concat(*numbers)


def _by_bands(s: Column, segments: Segments, least: float) -> Column:
    """Array of (license, containment) of the templates found in a text's shingles."""
    widest, minimal = segments.widest, segments.minimal()
    multipliers = _fixed([f"{m}L" for m in _multipliers()])
    known = _fixed([f"named_struct('t', {segments.templates[n]}, 'width', {segments.window(n)}, "
                    f"'h', array({', '.join(f'{h}L' for h in sorted(set(segments.hashes[n])))}))" for n in segments.numbers])

    def starts(q: Column) -> Column:
        low = F.greatest(q - (widest - 1), F.lit(1))
        return _range((low + F.lit(1) - low % 2).cast("int"), q, 2)

    def held(w: Column) -> Column:
        numbers = F.array_distinct(F.flatten(F.transform(multipliers, lambda m: _retrieved(w, m, segments))))
        return F.transform(numbers, lambda n: _let(F.get(known, n), lambda k: F.struct(
            k["t"].alias("t"), n.alias("n"),
            F.size(F.array_intersect(F.slice(w, F.lit(1), k["width"]), k["h"])).alias("held"))))
    places = F.filter(_range(F.lit(1), F.size(s)), lambda q: F.get(s, q - 1).isin(minimal))
    hits = F.flatten(F.transform(F.array_distinct(F.flatten(F.transform(places, starts))),
                                 lambda i: _let(F.slice(s, i, widest), held)))
    totals = F.array(*(F.lit(segments.totals[t]) for t in sorted(segments.totals)))
    names = F.array(*(F.lit(segments.names[t]) for t in sorted(segments.names)))

    def best(xs: Column) -> Column:
        """(t, n, held) by segment: what its best window holds."""
        return F.transform(F.array_distinct(F.transform(xs, lambda x: F.struct(x["t"].alias("t"), x["n"].alias("n")))),
                           lambda k: F.struct(k["t"].alias("t"), F.array_max(F.transform(F.filter(
                               xs, lambda x: x["n"] == k["n"]), lambda x: x["held"])).alias("held")))

    def by_template(bs: Column) -> Column:
        return F.transform(F.array_distinct(F.transform(bs, lambda b: b["t"])), lambda t: F.struct(
            F.get(names, t).alias("license"), (F.aggregate(F.filter(bs, lambda b: b["t"] == t), F.lit(0), lambda a, b: a + b["held"])
                                               / F.get(totals, t)).alias("containment")))
    return F.filter(_let(_let(hits, best), by_template), lambda x: x["containment"] >= least)


Wordings = Mapping[str, str | Sequence[str]]


def _found(spark: SparkSession, text: Column, templates: Wordings, least: float, statements: Wordings, names: Wordings,
           leads: Sequence[str]) -> Column:
    """Array of (license, containment) of the licenses found in a text; a license may stand there more than once."""
    given = _wordings(templates)
    counts = spark.createDataFrame(list(enumerate(x for _, x in given)), "t int, text string").select(
        "t", F.size(word_hashes(F.col("text"))).alias("n")).collect() if given else []  # the templates, a fixed list
    short = {r["t"] for r in counts if r["n"] < WORDS}
    exact = [given[t] for t in sorted(short)] + _wordings(statements)
    ways = []
    if long := [x for t, x in enumerate(given) if t not in short]:
        segments = Segments(spark, long)
        ways.append(lambda h: _let(shingles(h), lambda s: _by_bands(s, segments, least)))
    if exact or names:
        ways.append(Statements(spark, exact, _wordings(names), leads).find)
    if not ways:
        raise ValueError("nothing to look for")
    # bound by _let: in a column of its own the hashes would be computed anew for each place
    return _let(word_hashes(text), lambda h: F.concat(*(way(h) for way in ways)))


def find_licenses(docs: DataFrame, templates: Wordings = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
                  least: float = LEAST, *, statements: Wordings = {}, names: Wordings = {},
                  leads: Sequence[str] = ()) -> DataFrame:
    """(doc_id, license, containment) of every license found: ``templates`` by
    the share ``least`` of their shingles, ``statements`` word for word, and
    ``names`` word for word after one of ``leads``. One row per license of a row of ``docs``."""
    found = _found(docs.sparkSession, text_or_empty(text_col), templates, least, statements, names, leads)
    best = _let(found, lambda xs: F.transform(F.array_distinct(F.transform(xs, lambda x: x["license"])), lambda n: F.struct(
        n.alias("license"), F.array_max(F.transform(F.filter(xs, lambda x: x["license"] == n),
                                                    lambda x: x["containment"])).alias("containment"))))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(best).alias("_f")).select(
        "doc_id", "_f.license", "_f.containment")


def scan_licenses(docs: DataFrame, templates: Wordings = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
                  least: float = LEAST, *, statements: Wordings = {}, names: Wordings = {},
                  leads: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``licenses`` (array of names, sorted)."""
    found = _found(docs.sparkSession, text_or_empty(text_col), templates, least, statements, names, leads)
    return docs.select(F.col(id_col).alias("doc_id"), F.sort_array(F.array_distinct(
        F.transform(found, lambda x: x["license"]))).alias("licenses"))


def scan_all_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``scan_licenses`` for all of ``license_texts``."""
    return scan_licenses(docs, license_texts.TEXTS, id_col, text_col, statements=license_texts.STATEMENTS,
                         names=license_texts.NAMES, leads=license_texts.LEADS)
