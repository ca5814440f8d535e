"""Secret scan with corpus-wide ownership frequency.

Three base patterns are searched in every whole text. Beside them, long mixed
tokens (letters and digits) that no base span overlaps are candidates. Every
found value is hashed and counted over the whole corpus: rows, distinct
repositories, distinct owners. A value that many owners hold is a widely
copied example; a value that few owners hold, with the character mix of a real
key, looks live. Live-looking candidates become additional spans of kind
``live``; base spans always stay, marked shared or owner-specific.

Positions come from the pieces between matches: a match starts where the
lengths of all earlier pieces and matches end (in code points).

Defined results: a null text counts as empty (no spans); a null owner is one
owner of its own, likewise a null repository; repeated rows each give a row;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_lookup, text_or_empty

# fixed values: the three base patterns, their order and their least lengths
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

#: a candidate beyond the base patterns: a long token that has both letters and digits
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"


#: words that mark a documentation value
PLACEHOLDER = r"(?i)(example|sample|dummy|changeme|placeholder|xxxx|your[_-]?)"

_SPAN = "struct<s:int,k:int,e:int,kind:string,value:string>"
_KINDS = ("assign", "access", "hex", "live")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, b: a + b)


def _offsets(lengths: Column) -> Column:
    """Exclusive running total of a non-empty array of ints, in blocks of
    about sqrt(n) so that a text with very many matches stays cheap."""
    n = F.size(lengths)
    width = F.ceil(F.sqrt(n.cast("double"))).cast("int")
    blocks = F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1)

    def block(sums: Column, b: Column) -> Column:
        own = F.slice(lengths, b * width + 1, width)
        return _let(_total(F.slice(sums, F.lit(1), b)), lambda base: F.transform(
            F.sequence(F.lit(0), F.size(own) - 1),
            lambda i: base + _total(F.slice(lengths, b * width + 1, i))))

    sums = F.transform(blocks, lambda b: _total(F.slice(lengths, b * width + 1, width)))
    return F.flatten(_let(sums, lambda x: F.transform(blocks, lambda b: block(x, b))))


def _spans(text: Column, kind: str, pattern: str, least: int = 0) -> Column:
    """All matches as an array of spans; values shorter than ``least`` are
    dropped after matching."""
    group = 2 if kind == "assign" else 0
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def located(pieces: Column) -> Column:  # rows of (piece before, match, value)
        rows = F.zip_with(
            pieces, _offsets(F.transform(pieces, lambda p: F.length(p["g"]) + F.length(p["m"]))),
            lambda p, at: F.struct(
                (at + F.length(p["g"])).alias("s"), F.lit(_KINDS.index(kind)).alias("k"),
                (at + F.length(p["g"]) + F.length(p["m"])).alias("e"), F.lit(kind).alias("kind"),
                p["v"].alias("value")))
        return F.filter(rows, lambda r: F.length(r["value"]) >= least)

    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("g"), found.alias("m"), value.alias("v"))
    return F.when(text.rlike(pattern), _let(zipped, located)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _live_looking(value: Column) -> Column:
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)
            & (F.size(F.array_distinct(F.split(value, ""))) >= 10))


def find_spans(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo: Column) -> DataFrame:
    """(_row, doc_id, owner, repo, base, more) of every row, checkpointed."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                        repo.cast("string").alias("repo"), text_or_empty(text_col).alias("_t"))
    t = F.col("_t")
    base = texts.select(
        "*", F.concat(_spans(t, "assign", ASSIGN, ASSIGN_LEAST), _spans(t, "access", ACCESS),
                      _spans(t, "hex", HEX)).alias("base"), _spans(t, "live", TOKEN).alias("more"))

    def free(x: Column) -> Column:
        return ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))

    return cut(base.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "owner", "repo", "base",
                           F.filter("more", lambda x: _live_looking(x["value"]) & free(x)).alias("more")))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: rows, distinct repositories, distinct owners. Grouped
    by (hash, owner, repository) first, so a value that is everywhere arrives
    as one row per repository."""
    held = spans.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_found"), F.sum("repos").alias("n_repos"),
                                        F.count("*").alias("n_owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo: Column | None = None, shared_owners: int = 3, shared_repos: int = 6) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``live`` (spans),
    ``n_shared`` and ``n_owned`` (base spans whose value is widely copied, or
    owner-specific and live-looking).

    ``repo`` names the repository within an owner (default: the owner). A
    value at ``shared_owners`` owners or ``shared_repos`` repositories is
    widely copied.
    """
    found = find_spans(docs, id_col, text_col, owner_col, F.col(owner_col) if repo is None else repo)
    spans = cut(found.select("_row", "owner", "repo", F.explode(F.concat("base", "more")).alias("span"))
                .withColumn("hash", F.sha2(F.col("span.value"), 256)))
    counts = ownership(spans).select(
        "hash", ((F.col("n_owners") >= shared_owners) | (F.col("n_repos") >= shared_repos)).alias("shared"))
    judged = spread_lookup(spans, counts, ["hash"], ["_row"])
    live = F.col("span.kind") == "live"
    owned = ~F.col("shared") & _live_looking(F.col("span.value"))
    per_row = judged.groupBy("_row").agg(
        F.collect_list(F.when(live & owned, F.col("span"))).alias("live"),
        F.count(F.when(~live & F.col("shared"), 1)).alias("n_shared"),
        F.count(F.when(~live & owned, 1)).alias("n_owned"))
    none = F.array().cast(f"array<{_SPAN}>")
    return found.join(per_row, "_row", "left").select(
        "doc_id", "base", F.coalesce("live", none).alias("live"),
        F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"),
        F.coalesce("n_owned", F.lit(0).cast("long")).alias("n_owned"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind in the order of the contract."""
    return F.concat_ws(",", F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))))


def contract_columns(scanned: DataFrame) -> DataFrame:
    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.concat("base", "live")).alias("spans"), "n_shared", "n_owned")
