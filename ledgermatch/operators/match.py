"""Cash-vs-RADA matching on business keys.

Semantics
---------
Records of both ledgers that share a business key are paired one-to-one:

1. as many pairs as possible have amounts within the tolerance (inclusive,
   compared as decimals). Amounts of a key fall into runs, neighbours within
   a run at most the tolerance apart. Equal amounts are paired first, then a sweep
   up the run pairs the least amounts left; where the sweep alone
   gives more pairs in a run, the sweep alone stands;
2. what is left of the key is paired by rank: i-th least cash amount with the i-th
   least RADA amount, unknown amounts last.

Pairs of step 1 are MATCHED, those of step 2 AMOUNT_MISMATCH; cash records left
without a partner are UNMATCHED, RADA records without one are NEW. With unique
keys (the normal case) this is exactly a full outer equi-join on the key.
Which amounts pair depends on the key's amounts alone; identifiers (by MD5 prefix,
then value) only tell records of one amount apart. A null key pairs with nothing.

Plan
----
Counts per key, combined map-side, tell the keys that have records on both
sides and several on one. All other keys take one hash-partitioned full outer
join. A repeated key of at most ``_LARGE`` records is paired whole: rows are dealt by
key once, and a task walks its sorted keys. Rows of a larger key are stored and reduced
to one row per distinct amount and counts. Buckets of a thousand tolerances whose ends are within the
tolerance of each other form a chain, found over one row per bucket, so no window holds a whole key's
records. The sweep (a task walks a chain's sorted distinct amounts, run by run, and holds those within a
tolerance of the latest) tells how many records of an amount pair with equal amounts, with others or not at
all, and how many do so before it. Pairs of a sweep keep the order of amounts: the n-th cash record paired by
it goes with the n-th RADA record. So records need one shuffle: dealt by (key, bucket), a bucket of more than
``_PART`` records by equal shares of its width, numbered per (key, amount, side), they meet their partner in their
task, which holds those whose partner may still come. Only records whose partner lies in another part, or that pair
by rank, are dealt again, by what tells a pair. An amount of more than ``_HOT`` records, and unknown ones, are
numbered in slices of the identifier's MD5 and paired the second way. So a key, or one amount of a
key, that holds a third of all rows is spread over its parts or slices. Inside, a SHA-256 key is its 32 bytes,
half its text.

CLEARED detection needs the counts per key only: one-to-one pairing leaves a
cash record unpaired exactly when the key has more cash than RADA records. The
snapshot's keys are counted along, so the ledgers are not counted twice.
"""

from __future__ import annotations

import pickle
import sys
import tempfile
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from decimal import Decimal
from functools import reduce
from itertools import zip_longest
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (AMOUNT_MISMATCH, CASH, CLEARED, MATCHED, NEW, RADA, REASON_AMOUNT, REASON_MISSING_IN_CASH,
                      REASON_MISSING_IN_RADA, UNMATCHED, ReconConfig)
from ..functions.money import MONEY
from ..session import checkpoint_root, stored

# the sweep runs in Python workers and is sent by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: the output contract, columns and their order -----------
CASH_PAYLOAD = ("account_number", "trade_reference", "settlement_date", "currency", "swift_bic", "debit_credit")

RESULT_COLUMNS = (
    "business_key", "cash_id", "rada_id", "account_number", "trade_reference", "settlement_date",
    "currency", "amount", "rada_amount", "amount_variance", "swift_bic", "debit_credit",
    "recon_status", "mismatch_reason",
)
MATCHED_COLUMNS = (
    "business_key", "cash_id", "rada_id", "account_number", "trade_reference", "settlement_date",
    "currency", "amount", "rada_amount", "amount_variance", "swift_bic", "debit_credit", "recon_status",
)
UNMATCHED_COLUMNS = (
    "business_key", "cash_id", "account_number", "trade_reference", "settlement_date",
    "currency", "amount", "swift_bic", "debit_credit", "recon_status",
)
NEW_COLUMNS = ("business_key", "rada_id", "amount", "recon_status")
MISMATCH_COLUMNS = tuple(c for c in MATCHED_COLUMNS if c != "swift_bic")
# ---------------------------------------------------------------------------

_IN_CASH, _IN_RADA = "_in_cash is not null", "_in_rada is not null"
#: buckets in which runs of amounts are found: so many tolerances (or units) wide
_BUCKET = 1000
#: records of a key beyond which its pairing is spread over tasks
_LARGE = 2000
#: records of an amount of a key beyond which they are numbered in slices
_HOT = 2000
#: records of a bucket beyond which it is dealt in several parts
_PART = 100_000
#: kinds of what rides along that are few enough to be sent to every task, records naming theirs
_KINDS = 10_000
#: amounts of a run that a task holds in memory; more lie in a temporary file of its own
_HELD = 50_000
#: keys few enough to be sent to every task, instead of dealing all rows to meet them
_LISTED = 100_000


def exact(amount: Column) -> Column:
    """Amount as a decimal; NULL where a double has none (NaN, infinity, beyond 32 digits)."""
    return amount.try_cast(MONEY)


def _sides(cash: DataFrame, rada: DataFrame, cash_id: str, rada_id: str, payload=CASH_PAYLOAD,
           rada_payload=()) -> tuple[DataFrame, DataFrame]:
    """Both ledgers, slimmed to what the result needs."""
    return (cash.select("business_key", F.col(cash_id).alias("cash_id"), F.col("amount").alias("_cash_amount"),
                        *payload, F.lit(1).alias("_in_cash")),
            rada.select("business_key", F.col(rada_id).alias("rada_id"), F.col("amount").alias("_rada_amount"),
                        *rada_payload, F.lit(1).alias("_in_rada")))


def _packed(key: Column) -> Column:
    """A SHA-256 key as its 32 bytes; any other text as its bytes after 33 zeros, so that no two keys meet."""
    digest = F.unhex(key)
    return (F.when((F.length(key) == 64) & (F.lower(F.hex(digest)) == key), digest)
            .when(key.isNotNull(), F.concat(F.lit(bytes(33)), key.cast("binary"))))


def _unpacked(key: Column) -> Column:
    return F.when(F.octet_length(key) == 32, F.lower(F.hex(key))).otherwise(
        F.substring(key, 34, 2**31 - 1).cast("string"))


def _counts(cash: DataFrame, rada: DataFrame, before: DataFrame | None, by: Column) -> DataFrame:
    """(_by, _c, _r, _b): records of each key, and how often ``before`` has it."""
    def ones(df: DataFrame, name: str) -> DataFrame:
        return df.select(by.alias("_by"), *[F.lit(int(c == name)).alias(c) for c in ("_c", "_r", "_b")])
    rows = ones(cash, "_c").unionByName(ones(rada, "_r"))
    if before is not None:
        rows = rows.unionByName(ones(before, "_b"))
    return rows.groupBy("_by").agg(*[F.sum(c).alias(c) for c in ("_c", "_r", "_b")])


# --- runs of amounts -------------------------------------------------------

def _swept(rows: Iterable[tuple], tolerance, equal_first: bool) -> Iterator[list]:
    """The sweep up a run of (amount, cash records, RADA records): [amount, cash records, RADA
    records, equal, cash paired, RADA paired, cash to, RADA to], the last two lists of (other
    amount, after, n), of each amount in order, once none up to it can pair with a later one.
    Pairing the least amounts within the tolerance first gives a largest pairing.
    ``equal_first``: of what equal amounts leave over."""
    waiting, side = deque(), 0  # amounts within the tolerance that have records left, all of one side
    line = deque()  # the least of these and all after it
    for at, c, r in rows:
        equal = min(c, r) if equal_first else 0
        fact = [at, c, r, equal, equal, equal, [], []]
        line.append(fact)
        while waiting and at - waiting[0][0] > tolerance:
            waiting.popleft()
        n = (r if side == 0 else c) - equal
        while n and waiting:
            least = waiting[0]
            pairs = min(n, least[1 + side] - least[4 + side])
            least[6 + side].append((at, least[4 + side], pairs))
            fact[7 - side].append((least[0], fact[5 - side], pairs))
            least[4 + side] += pairs
            fact[5 - side] += pairs
            n -= pairs
            if least[4 + side] == least[1 + side]:
                waiting.popleft()
        if own := min(c - fact[4], r - fact[5]):
            for i in (0, 1):
                fact[6 + i].append((at, fact[4 + i], own))
                fact[4 + i] += own
        if fact[4] < c or fact[5] < r:
            side = 0 if fact[4] < c else 1
            waiting.append(fact)
        while line and not (waiting and line[0] is waiting[0]):
            yield line.popleft()
    yield from line


def _equal_first(rows: Iterable[tuple], tolerance) -> bool:
    """Whether pairing equal amounts first costs the run no pair."""
    with_equal, without = (sum(map(itemgetter(4), _swept(rows, tolerance, first))) for first in (True, False))
    return with_equal == without


def allot(run: list[tuple], tolerance: Decimal) -> list[dict]:
    """What pairs with what in a run of (amount, cash records, RADA records)."""
    return [{"_at": at, "equal": equal, "cash_paired": cash, "rada_paired": rada,
             **{name: [{"other": other, "after": after, "n": n} for other, after, n in to] for name, to in zip(("cash_to", "rada_to"), tos, strict=True)}}
            for at, _, _, equal, cash, rada, *tos in _swept(run, tolerance, _equal_first(run, tolerance))]


_DECIMAL = pa.decimal128(38, 6)
_TO = pa.list_(pa.struct({"other": _DECIMAL, "after": pa.int64(), "n": pa.int64()}))
#: of an amount: its records, how many pair, and how many of the chain do so by the sweep or are left before it
_NUMBERS = ("_c", "_r", "equal", "cash_paired", "rada_paired", "_cash_swept", "_rada_swept", "_cash_from", "_rada_from")
_FACTS_DDL = f"business_key binary, _run long, _at {MONEY}, {', '.join(f'{c} long' for c in _NUMBERS)}"


class _Run:
    """The rows of a run, in columns, walked several times."""

    def __init__(self):
        self.columns, self.held, self.file, self.stored = [], 0, None, 0

    def add(self, columns: list[list]) -> None:
        self.columns.append(columns)
        self.held += len(columns[0])
        if self.held > _HELD:
            self.file = self.file or tempfile.TemporaryFile()
            for part in self.columns:
                pickle.dump(part, self.file)
            self.stored += len(self.columns)
            self.columns, self.held = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file:
            self.file.seek(0)
        for _ in range(self.stored):
            yield from zip(*pickle.load(self.file), strict=True)
        for part in self.columns:
            yield from zip(*part, strict=True)


def _millionths(amounts: pa.Array) -> list[int]:
    low, high = np.frombuffer(amounts.buffers()[1], "<i8").reshape(-1, 2)[amounts.offset:amounts.offset + len(amounts)].T
    if (high == low >> 63).all():  # 64 bits hold them
        return low.tolist()
    return [int(f"{at:f}".replace(".", "")) for at in amounts.to_pylist()]


def _money(millionths: list[int]) -> pa.Array:
    try:
        low = np.array(millionths, np.int64)
    except OverflowError:
        return pa.array([Decimal(f"{x}e-6") for x in millionths], _DECIMAL)
    return pa.Array.from_buffers(_DECIMAL, len(low), [None, pa.py_buffer(np.stack([low, low >> 63], 1).tobytes())])


def _sweep(tolerance: Decimal, lists: bool = True):
    """Sorted (business_key, _run, _at, _c, _r), ``_run`` any whole runs of a key -> the facts of every amount;
    ``lists``: with what pairs with what. Nothing is held of what comes out, and of a run (its amounts in
    millionths) ``_HELD`` amounts and those of a tolerance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = int(tolerance.scaleb(6))
        kind = pa.int64()

        def to(lists: list[list[tuple]]) -> pa.Array:
            other, after, n = map(list, zip(*flat, strict=True)) if (flat := [x for one in lists for x in one]) else ([], [], [])
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, lists)]), pa.int32()), pa.StructArray.from_arrays(
                [_money(other), pa.array(after, pa.int64()), pa.array(n, pa.int64())], names=["other", "after", "n"]), type=_TO)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            keys, start, at, *numbers, cash_to, rada_to = map(list, zip(*rows, strict=True))
            columns = [pa.array(keys, pa.binary()), pa.array(start, kind), _money(at), *(pa.array(x, pa.int64()) for x in numbers)]
            names = ["business_key", "_run", "_at", *_NUMBERS]
            if lists:
                columns, names = [*columns, to(cash_to), to(rada_to)], [*names, "cash_to", "rada_to"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def runs() -> Iterator[tuple[tuple, _Run]]:
            nonlocal kind
            now, last, held = None, 0, _Run()
            for part in batches:
                if not part.num_rows:
                    continue
                keys, start, at = part.column(0), part.column(1), _millionths(part.column(2))
                c, r = (part.column(name).to_pylist() for name in ("_c", "_r"))
                kind = start.type
                new = pc.or_(*(pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)) for x in (keys, start))).to_numpy(zero_copy_only=False)
                new |= np.fromiter((y - x > step for x, y in zip(at, at[1:], strict=False)), bool, len(new))
                places = [0, *(np.flatnonzero(new) + 1).tolist(), len(at)]
                for x, y in zip(places, places[1:], strict=False):
                    this = keys[x].as_py(), start[x].as_py()
                    if now != this or at[x] - last > step:
                        if now:
                            yield now, held
                        now, held = this, _Run()
                    held.add([at[x:y], c[x:y], r[x:y]])
                    last = at[y - 1]
            if now:
                yield now, held

        out: list[tuple] = []
        now, before = None, [0, 0, 0, 0]
        for this, one in runs():
            if now != this:
                now, before = this, [0, 0, 0, 0]
            for at, c, r, equal, cash, rada, *tos in _swept(one, step, _equal_first(one, step)):
                out.append((*this, at, c, r, equal, cash, rada, *before, *tos))
                before = [x + y for x, y in zip(before, (cash - equal, rada - equal, c - cash, r - rada), strict=True)]
                if len(out) == 10_000:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)
    return run


def _listed(small: DataFrame, number: int) -> DataFrame:
    return F.broadcast(small) if number <= _LISTED else small


def _in_millionths(rows: DataFrame, amount: Column) -> DataFrame:
    """Adds the exact amount as ``_at``, in millionths, which sort fast; one that 64 bits do not hold is in ``_beyond``."""
    fits = F.abs(amount) < 9_000_000_000_000
    return rows.withColumns({
        "_beyond": F.when(~fits, amount), "_at": F.when(fits, (amount * 1_000_000).cast("long"))
        .when(amount > 0, F.lit(2**63 - 1)).when(amount < 0, F.lit(-2**63))})


def _about() -> Column:
    """The amount as a double, no less than that of a lesser amount."""
    return F.coalesce(F.col("_beyond").cast("double"), F.col("_at").cast("double") / 1e6)


def _bucketed(rows: DataFrame, tolerance: float) -> DataFrame:
    """Adds ``_bucket``, a thousand tolerances wide."""
    return rows.withColumn("_bucket", F.floor(_about() / F.lit(max(tolerance, 1.0) * _BUCKET)))


def _chains(amounts: DataFrame, tolerance: float) -> DataFrame:
    """Per (key, bucket): ``_of``, its records, and ``_run``, the first bucket of those that it forms a chain with."""
    step = F.lit(repr(float(tolerance))).cast(MONEY)
    by_bucket = Window.partitionBy("business_key").orderBy("_bucket")
    ends = amounts.groupBy("business_key", "_bucket").agg(
        F.min("_exact").alias("_low"), F.max("_exact").alias("_high"), F.sum(F.col("_c") + F.col("_r")).alias("_of"))
    before = F.lag("_high").over(by_bucket)
    opened = ends.withColumn("_opens", F.when(before.isNull() | (F.col("_low") - before > step), F.col("_bucket")))
    return stored(opened.select("business_key", "_bucket", "_of", F.max("_opens").over(by_bucket).alias("_run")), "chains")


def _facts(known: DataFrame, unknown: DataFrame, chains: DataFrame, buckets: int, tolerance: float) -> DataFrame:
    """Per (key, amount) its ``_NUMBERS``, those of a chain made those of the key, and ``_pairs``, how many
    of the key's left-over records pair by rank. ``_at`` is NULL for unknown amounts, the last of a key."""
    zero = F.lit(0).cast("long")
    in_chains = known.join(_listed(chains.drop("_of"), buckets), ["business_key", "_bucket"]).select(
        "business_key", "_run", F.col("_exact").alias("_at"), "_c", "_r")
    swept = (in_chains.repartition("business_key", "_run").sortWithinPartitions("business_key", "_run", "_at")
             .mapInArrow(_sweep(Decimal(repr(float(tolerance))), lists=False), _FACTS_DDL))
    swept = _in_millionths(swept.withColumnRenamed("_at", "_exact"), F.col("_exact"))
    names = ["business_key", "_run", "_at", "_beyond", *_NUMBERS]
    # read twice below: unless stored, the sweep would run twice
    facts = stored(swept.select(*names).unionByName(unknown.select(*[F.col(c) if c in unknown.columns else zero.alias(c) for c in names])),
                   "facts").withColumn("_known", F.col("_at").isNotNull())
    chain = ["business_key", "_known", "_run"]
    sums = facts.groupBy(*chain).agg(
        F.sum(F.col("cash_paired") - F.col("equal")).alias("_swept"),
        *[F.sum(F.col(of) - F.col(f"{s}_paired")).alias(f"_{s}") for s, of in (("cash", "_c"), ("rada", "_r"))])
    whole = Window.partitionBy("business_key")
    earlier = whole.orderBy(F.col("_known").desc(), "_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(sums.select(
        *chain, F.least(F.sum("_cash").over(whole), F.sum("_rada").over(whole)).alias("_pairs"),
        *[F.coalesce(F.sum(c).over(earlier), zero).alias(c) for c in ("_swept", "_cash", "_rada")]), "sums")
    return stored(facts.join(_listed(sums, sums.count()), chain).select(
        "business_key", "_at", "_beyond", *_NUMBERS[:5], *[(F.col(f"_{s}_swept") + F.col("_swept")).alias(f"_{s}_swept") for s in ("cash", "rada")],
        *[(F.col(f"_{s}_from") + F.col(f"_{s}")).alias(f"_{s}_from") for s in ("cash", "rada")], "_pairs"), "ranks")


def _token(side: str) -> Column:
    """What a record's number ``_k`` within (key, amount, side) stands for: the
    same on both records of a pair."""
    k, equal, paired = F.col("_k"), F.col("equal"), F.col(f"{side}_paired")
    return (F.when(k <= equal, F.concat_ws("|", F.lit("e"), "_at", "_beyond", k))
            .when(k <= paired, F.concat_ws("|", F.lit("s"), F.col(f"_{side}_swept") + k - equal))
            .otherwise(F.concat_ws("|", F.lit("l"), F.col(f"_{side}_from") + k - paired)))


def _stacked(cash: DataFrame, rada: DataFrame) -> DataFrame:
    """Rows of both sides in one shape."""
    mine, theirs = cash.columns[3:-1], rada.columns[3:-1]  # what rides along on each side

    def side(ledger: DataFrame, number: int, id_col: str, amount: str) -> DataFrame:
        others = {c: d.schema[c].dataType for d, names in ((cash, mine), (rada, theirs)) for c in names}
        return ledger.select(
            "business_key", F.lit(number).alias("_side"), F.col(id_col).alias("_rid"), F.col(amount).alias("_amt"),
            *[F.col(c) if c in ledger.columns else F.lit(None).cast(t).alias(c) for c, t in others.items()])
    return side(cash, 0, "cash_id", "_cash_amount").unionByName(side(rada, 1, "rada_id", "_rada_amount"))


def _sliced(rows: DataFrame) -> DataFrame:
    """Adds the slice that, before the identifier, orders rows of one amount."""
    return rows.withColumn("_slice", F.coalesce(F.substring(F.md5("_rid"), 1, 2), F.lit("")))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their exact amount and their slice."""
    return _sliced(rows.withColumn("_at", exact(F.col("_amt"))))


def pair_key(cash: list, rada: list, tolerance: Decimal) -> list[tuple[int | None, int | None]]:
    """The places paired of a key's cash and RADA amounts, each ascending with unknown ones last."""
    places: dict = {}
    for side, amounts in enumerate((cash, rada)):
        for place, amount in enumerate(amounts):
            if amount is not None:
                places.setdefault(amount, ([], []))[side].append(place)
    out, left, run = [], ([], []), []
    for amount in [*sorted(places), None]:
        if run and (amount is None or amount - run[-1][0] > tolerance):
            facts = allot(run, tolerance)
            told = {fact["_at"]: {to["other"]: to["after"] for to in fact["rada_to"]} for fact in facts}
            for fact in facts:
                c, r = places[fact["_at"]]
                out += zip(c[:fact["equal"]], r[:fact["equal"]], strict=True)
                for to in fact["cash_to"]:
                    after = told[to["other"]][fact["_at"]]
                    out += zip(c[to["after"]:to["after"] + to["n"]], places[to["other"]][1][after:after + to["n"]], strict=True)
                left[0].extend(c[fact["cash_paired"]:])
                left[1].extend(r[fact["rada_paired"]:])
            run = []
        if amount is not None:
            run.append((amount, *map(len, places[amount])))
    for side, amounts in enumerate((cash, rada)):
        left[side].extend(place for place, amount in enumerate(amounts) if amount is None)
    return out + list(zip_longest(*left))


def _walk(tolerance: Decimal, cash_from: Sequence[str], rada_from: Sequence[str], names: Sequence[str]):
    """Rows sorted by (key, side, amount, order of records) -> pairs and single records of each key."""
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        side, at = rows["_side"].to_numpy(), rows["_at"].to_pylist()
        starts = np.concatenate([[0], _new_keys(rows), [len(rows)]]).tolist()
        seen = np.concatenate([[0], np.cumsum(side)]).tolist()  # RADA rows before each row
        out = []
        for start, end in zip(starts, starts[1:], strict=False):
            middle = end - (seen[end] - seen[start])
            if middle in (start, end) or end - start == 2:
                out += zip_longest(range(start, middle), range(middle, end))
            else:
                out += ((None if i is None else start + i, None if j is None else middle + j)
                        for i, j in pair_key(at[start:middle], at[middle:end], tolerance))
        cash, rada = (pa.array(x, pa.int64()) for x in zip(*out, strict=True))
        columns = [rows["business_key"].take(pc.coalesce(cash, rada))]
        for sources, places in ((cash_from, cash), (rada_from, rada)):
            columns += [rows[c].take(places) for c in sources]
            columns.append(pc.if_else(pc.is_valid(places), pa.scalar(1, pa.int32()), pa.scalar(None, pa.int32())))
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            whole = _new_keys(held)[-1:]  # the last key may go on in the next batch
            if len(whole):
                yield pairs(held.slice(0, int(whole[0])))
                held = held.slice(int(whole[0]))
        if held is not None:
            yield pairs(held)
    return run


def _new_keys(rows: pa.Table) -> np.ndarray:
    """Places, but the first, at which a key begins."""
    keys = rows["business_key"].combine_chunks()
    return np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1


def _paired_by_key(cash: DataFrame, rada: DataFrame, tolerance: float) -> DataFrame:
    """Pairs and single records of keys of few records each: rows are dealt by key, once."""
    mine, theirs = cash.columns[3:-1], rada.columns[3:-1]
    rows = _placed(_stacked(cash, rada).repartition("business_key")).sortWithinPartitions(
        "business_key", "_side", F.col("_at").asc_nulls_last(), "_slice", F.col("_rid").asc_nulls_first())
    fields = [T.StructField(f.name, f.dataType, True) for f in (*cash.schema.fields, *rada.schema.fields[1:])]
    return rows.mapInArrow(_walk(Decimal(repr(float(tolerance))), ["_rid", "_amt", *mine], ["_rid", "_amt", *theirs],
                                 [f.name for f in fields]), T.StructType(fields))


def _same(a: DataFrame, b: DataFrame, names: Sequence[str] = ("business_key",)) -> Column:
    """Equal in amount, unknown ones too, and in ``names``."""
    return reduce(Column.__and__, [a[name] == b[name] for name in names],
                  a["_at"].eqNullSafe(b["_at"]) & a["_beyond"].eqNullSafe(b["_beyond"]))


def _numbered_in_slices(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``_k``, a record's number within (key, amount, side), and the facts; an amount's records are spread over slices."""
    group = ["business_key", "_side", "_at", "_beyond"]
    part = [*group, "_slice"]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_of")).select(
        *part, F.coalesce(F.sum("_of").over(earlier), F.lit(0)).alias("_before"))
    told = slices.join(facts, _same(slices, facts)).drop(*[facts[c] for c in ("business_key", "_at", "_beyond")])
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*part).orderBy(F.col("_rid").asc_nulls_first())))
    names = ["business_key", "_side", "_slice"]
    return own.join(told, _same(own, told, names)).drop(*[told[c] for c in (*names, "_at", "_beyond")]).withColumn(
        "_k", F.col("_own") + F.col("_before"))


#: types of what rides along that equal values tell apart
_NAMED = (T.StringType, T.DateType, T.IntegerType, T.LongType, T.BooleanType)
#: of ``_facts``, what a record's number is read against
_READ = ("equal", "cash_paired", "rada_paired", "_cash_swept", "_rada_swept", "_cash_from", "_rada_from", "_pairs")


def _meet(mine: Sequence[str], theirs: Sequence[str], names: Sequence[str], kinds: pa.Table | None, apart: bool):
    """Rows sorted by (key, part, amount, side, number): of each amount its facts, then its records -> the pairs within
    a part and the records that pair with none; ``apart``: instead the records that have their partner elsewhere, with
    the token of the pair. ``kinds``: what rides along, by the ``_what`` that records name. Held are the records whose partner may still come: those of an amount, or of a tolerance."""
    kept = ["business_key", "_side", "_rid", "_amt", *([*mine, *theirs] if kinds is None else ["_what"])]

    def riding(rows: pa.Table, names: Sequence[str], places: pa.Array) -> list:
        if kinds is None:
            return [rows[c].take(places) for c in names]
        kind = pa.array(np.searchsorted(kinds["_what"].to_numpy(), rows["_what"].to_numpy())).take(places)
        return [kinds[c].take(kind) for c in names]

    def places(cash: np.ndarray, rada: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of equal numbers in two ascending arrays."""
        at = np.searchsorted(rada, cash)
        same = np.append(rada, -1)[at] == cash
        return np.flatnonzero(same), at[same]

    def paired(rows: pa.Table, cash: np.ndarray, rada: np.ndarray, alone: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        none = np.full(len(alone), -1)
        ends = [np.concatenate([both, np.where(side[alone] == i, alone, none)]) for i, both in enumerate((cash, rada))]
        ends = [pa.array(x, pa.int64(), mask=x < 0) for x in ends]
        columns = [rows["business_key"].take(pc.coalesce(*ends))]
        for sources, end in ((mine, ends[0]), (theirs, ends[1])):
            columns += [*(rows[c].take(end) for c in ("_rid", "_amt")), *riding(rows, sources, end)]
            columns.append(pc.if_else(pc.is_valid(end), pa.scalar(1, pa.int32()), pa.scalar(None, pa.int32())))
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=list(names))

    def told(rows: pa.Table, kind: np.ndarray, number: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        token = pa.array([f"{'esl'[x]}|{n}" for x, n in zip(kind[of].tolist(), number[of].tolist(), strict=True)], pa.string())
        of = pa.array(of, pa.int64())
        columns = [c.combine_chunks() for c in (*(rows[c].take(of) for c in kept[:4]), *riding(rows, [*mine, *theirs], of))]
        return pa.RecordBatch.from_arrays([*columns, token], names=[*kept[:4], *mine, *theirs, "_token"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers = None, np.empty((4, 0), np.int64)  # records, and their side, kind, place and number
        amount = part = 0  # how many came before, this one included
        last, fact = (None, None), np.zeros((1, len(_READ)), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            side = batch["_side"].to_numpy().astype(np.int64)
            tells = side < 0
            facts = np.concatenate([fact, batch["_fact"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_READ))])
            nth = np.cumsum(tells)
            keys, parts = batch["business_key"].filter(pa.array(tells)), batch["_part"].to_numpy()[tells]
            new = np.ones(len(keys), bool)
            if len(keys):
                new[0] = last != (keys[0].as_py(), parts[0])
                new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False) | (parts[1:] != parts[:-1])
                last = keys[-1].as_py(), parts[-1]
            of_part = part + np.concatenate([[0], np.cumsum(new)])
            # what each record's number stands for
            side, nth, k = side[~tells], nth[~tells], batch["_k"].to_numpy()[~tells].astype(np.int64)
            equal, cash_paired, rada_paired, cash_swept, rada_swept, cash_from, rada_from, pairs = facts[nth].T
            done = np.where(side == 0, cash_paired, rada_paired)
            kind = np.where(k <= equal, 0, np.where(k <= done, 1, 2))
            number = np.choose(kind, [k, np.where(side == 0, cash_swept, rada_swept) + k - equal,
                                      np.where(side == 0, cash_from, rada_from) + k - done])
            place = np.where(kind == 0, amount + nth, of_part[nth])
            alone = (kind == 2) & (number > pairs)
            rows = pa.Table.from_batches([batch.select(kept).filter(pa.array(~tells))])
            rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
            alone = np.concatenate([np.zeros(numbers.shape[1], bool), alone])
            side, kind, place, number = numbers = np.concatenate([numbers, [side, kind, place, number]], axis=1)
            amount, part, fact = amount + len(keys), int(of_part[-1]), facts[-1:]
            # partners that are here
            open_ = ~alone
            both = [[], []]
            for x in (0, 1):
                of = [np.flatnonzero((kind == x) & (side == y)) for y in (0, 1)]
                least = min((place[y[0]] for y in of if len(y)), default=0)
                found = places(*(((place[y] - least) << 40) + number[y] for y in of))
                for y in (0, 1):
                    both[y].append(of[y][found[y]])
            cash, rada = map(np.concatenate, both)
            open_[cash] = open_[rada] = False
            # of the others, those whose partner may come
            come = np.where(side == 0, fact[0, 4], fact[0, 3])  # so many of the other side came before this amount
            waits = open_ & np.where(kind == 0, place == amount, (kind == 1) & (place == part) & (number > come))
            if apart:
                if len(of := np.flatnonzero(open_ & ~waits)):
                    yield told(rows, kind, number, of)
            elif len(cash) or alone.any():
                yield paired(rows, cash, rada, np.flatnonzero(alone), side)
            held, numbers = rows.filter(pa.array(waits)), numbers[:, waits]
        if apart and held is not None and len(held):
            yield told(held, numbers[1], numbers[3], np.arange(len(held)))
    return run


def _in_parts(rows: DataFrame, crowded: DataFrame | None, tolerance: float) -> DataFrame:
    """Adds ``_part``, which with the key tells what is dealt together: a bucket, or a share of a crowded one's width."""
    rows, wide = _bucketed(rows, tolerance), max(tolerance, 1.0) * _BUCKET
    if crowded is None:
        return rows.withColumn("_part", F.col("_bucket")).drop("_bucket")
    share = F.floor((_about() / F.lit(wide) - F.col("_bucket")) * F.col("_shares"))
    return (rows.join(crowded, ["business_key", "_bucket"], "left")
            .withColumn("_part", F.xxhash64("_bucket", F.coalesce(share, F.lit(0)))).drop("_bucket", "_shares"))


def _paired_by_token(rows: DataFrame, mine: Sequence[str], theirs: Sequence[str]) -> DataFrame:
    """Rows of both sides, a token at most once on each: the pairs and the rows without a partner."""
    order = Window.partitionBy("business_key", "_token").orderBy("_side")
    met = rows.withColumns({"_twin": F.lead(F.struct("_in_row", "_rid", "_amt", *theirs)).over(order), "_before": F.lag("_in_row").over(order)})

    def rada(name: str) -> Column:
        return F.when(F.col("_side") == 0, F.col(f"_twin.{name}")).otherwise(F.col(name))
    cash = F.col("_side") == 0
    return met.filter(cash | F.col("_before").isNull()).select(
        "business_key", F.when(cash, F.col("_rid")).alias("cash_id"), F.when(cash, F.col("_amt")).alias("_cash_amount"), *mine,
        F.when(cash, F.lit(1)).alias("_in_cash"), rada("_rid").alias("rada_id"), rada("_amt").alias("_rada_amount"),
        *[rada(c).alias(c) for c in theirs], rada("_in_row").alias("_in_rada"))


def _paired_in_keys(cash: DataFrame, rada: DataFrame, tolerance: float) -> DataFrame:
    """The pairs and single records of keys of any number of records."""
    mine, theirs = cash.columns[3:-1], rada.columns[3:-1]
    rows = _stacked(cash, rada)
    ride = [f for f in rows.schema.fields if f.name in (*mine, *theirs)]
    rows = _in_millionths(rows.withColumn("_exact", exact(F.col("_amt"))), F.col("_exact")).drop("_exact").withColumn(
        "_what", F.xxhash64(F.lit(0), *[x for f in ride for x in (F.col(f.name), F.col(f.name).isNull())]))
    # an amount is kept beside its millionths only where these do not give it back
    double, amount, seen = F.col("_at").cast("double") / 1e6, F.col("_amt"), Observation("kinds")
    rows = rows.withColumn("_amt", F.when((double == amount) & (amount != 0.0), F.lit(None)).otherwise(amount))
    rows = stored(rows.observe(seen, F.approx_count_distinct("_what").alias("number")), "rows")
    whole, kinds = rows.withColumn("_amt", F.coalesce(amount, double)), None
    if all(isinstance(f.dataType, _NAMED) for f in ride) and seen.get["number"] <= _KINDS:
        kinds = rows.select("_what", *mine, *theirs).distinct().toArrow().sort_by("_what").combine_chunks()
        if len(kinds) > len(kinds["_what"].unique()):  # two of one hash
            kinds = None
    # one row per distinct amount, read for the chains, for their sweep and for the hot ones
    amounts = stored(rows.groupBy("business_key", "_at", "_beyond").agg(
        F.count_if(F.col("_side") == 0).alias("_c"), F.count_if(F.col("_side") == 1).alias("_r")), "amounts")
    known = _bucketed(amounts.filter("_at is not null"), tolerance).withColumn(
        "_exact", F.coalesce("_beyond", (F.col("_at").cast(MONEY) * F.lit("0.000001").cast("decimal(6,6)")).cast(MONEY)))
    chains = _chains(known, tolerance)
    buckets, records, crowds = chains.agg(F.count(F.lit(1)), F.coalesce(F.sum("_of"), F.lit(0)), F.count_if(F.col("_of") > _PART)).first()
    facts = _facts(known, amounts.filter("_at is null"), chains, buckets, tolerance)
    hot = amounts.filter(f"_at is null or _c + _r > {_HOT}").select("business_key", "_at", "_beyond")
    number, few, numbered = hot.count(), rows, []
    if number:
        listed = _listed(hot, number)
        few = rows.join(listed, _same(rows, listed), "left_anti")
        of_hot = _sliced(whole.join(listed, _same(whole, listed), "left_semi"))
        numbered.append(_numbered_in_slices(of_hot, facts.filter(f"_at is null or _c + _r > {_HOT}")).select(
            "business_key", "_side", "_rid", "_amt", *mine, *theirs,
            F.when(F.col("_side") == 0, _token("cash")).otherwise(_token("rada")).alias("_token")))
    crowded = None
    if crowds:
        crowded = _listed(chains.filter(F.col("_of") > _PART).select(
            "business_key", "_bucket", F.ceil(F.col("_of") / _PART).alias("_shares")), crowds)
    # the facts of an amount go with its records, before them: rows are dealt once, so many that a task sorts in memory
    told = facts.filter(f"_at is not null and _c + _r <= {_HOT}").select(
        "business_key", "_at", "_beyond", F.lit(-1).alias("_side"), F.array(*_READ).alias("_fact"))
    along = [*mine, *theirs] if kinds is None else ["_what"]
    few = few.select("business_key", "_side", "_rid", "_amt", *along, "_at", "_beyond")
    dealt = _in_parts(few.unionByName(told, allowMissingColumns=True), crowded, tolerance).repartition(
        max(8, records // (2 * _PART)), "business_key", "_part")
    # rows that differ in anything have an order: what is worked out twice below comes out alike
    order = Window.partitionBy("business_key", "_part", "_at", "_beyond", "_side").orderBy(
        "_slice", F.col("_rid").asc_nulls_first(), "_amt", *along)
    few = (_sliced(dealt.withColumn("_amt", F.coalesce(amount, double))).withColumn("_k", F.row_number().over(order))
           .select("business_key", "_part", "_side", "_rid", "_amt", *along, "_fact", "_k"))
    pair = [*cash.schema.fields, *rada.schema.fields[1:]]
    lone = [*whole.select("business_key", "_side", "_rid", "_amt", *mine, *theirs).schema.fields, T.StructField("_token", T.StringType())]
    near, far = (few.mapInArrow(_meet(mine, theirs, [f.name for f in pair], kinds, apart),
                                T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
                 for apart, fields in ((False, pair), (True, lone)))
    far = reduce(DataFrame.unionByName, [*numbered, far]).withColumn("_in_row", F.lit(1))
    return near.unionByName(_paired_by_token(far, mine, theirs))


def _joined(cash: DataFrame, rada: DataFrame, on: list[str]) -> DataFrame:
    return cash.join(rada, on, "full_outer")


def _match(cash: DataFrame, rada: DataFrame, tolerance: float,
           before: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Every record of both sides in exactly one row; and the keys of ``before`` that have
    no unpaired cash record now, once each."""
    checkpoint_root(cash.sparkSession)
    cash, rada, before = (df and df.withColumn("business_key", _packed(F.col("business_key"))) for df in (cash, rada, before))
    # without a snapshot hashes do: keys that share one are only paired the longer way
    by = F.col("business_key") if before is not None else F.when(F.col("business_key").isNotNull(), F.xxhash64("business_key"))
    large = f"_c + _r > {_LARGE}"
    seen = Observation("keys")
    counts = _counts(cash, rada, before, by).observe(
        seen, F.count_if(F.expr("_by is null")).alias("null"), F.count_if(F.expr(f"not ({large})")).alias("small"))
    kept = stored(counts.filter(f"(_c > 0 and _r > 0 and _c + _r > 2) or {large} or (_b > 0 and _c <= _r)"), "keys")
    told = kept.filter("_by is not null").select("_by", F.expr(
        f"case when _c > 0 and _r > 0 and {large} then 'large' when {large} then 'lone' "
        "when _c > 0 and _r > 0 and _c + _r > 2 then 'small' end").alias("_kind")).filter("_kind is not null")
    number = {r["_kind"]: r["count"] for r in told.groupBy("_kind").count().collect()}

    def split(sides: list[DataFrame], kind: str) -> tuple[list[DataFrame], list[DataFrame]]:
        """The sides' records in keys of a kind, and the others."""
        keys = told.filter(F.col("_kind") == kind).select("_by")
        keys = F.broadcast(keys) if number[kind] <= _LISTED else keys
        return [[side.join(keys, by == F.col("_by"), how) for side in sides] for how in ("left_semi", "left_anti")]

    parts, rest = [], [cash, rada]
    if "large" in number:
        of_large, rest = split(rest, "large")
        parts.append(_paired_in_keys(*of_large, tolerance))
    if number.get("small", 0) > _LISTED:  # too many to single out: all keys of few records go the same way
        if "lone" in number:
            lone, rest = split(rest, "lone")
            parts.append(_joined(*lone, ["business_key"]))
        parts.append(_paired_by_key(*[side.filter("business_key is not null") for side in rest], tolerance))
        if seen.get["null"]:
            parts.append(_joined(*[side.filter("business_key is null") for side in rest], ["business_key"]))
    else:
        if "small" in number:
            of_small, rest = split(rest, "small")
            parts.append(_paired_by_key(*of_small, tolerance))
        if not parts or "lone" in number or seen.get["small"] > number.get("small", 0) or seen.get["null"]:
            parts.append(_joined(*rest, ["business_key"]))
    pairs = reduce(DataFrame.unionByName, parts)
    unpack = _unpacked(F.col("business_key")).alias("business_key")
    cleared = None if before is None else kept.filter("_b > 0 and _c <= _r").select(_unpacked(F.col("_by")).alias("business_key"))
    return pairs.select(unpack, *[c for c in pairs.columns if c != "business_key"]), cleared


def _pairs(cash: DataFrame, rada: DataFrame, tolerance: float) -> DataFrame:
    return _match(cash, rada, tolerance)[0]


def pair_records(cash: DataFrame, rada: DataFrame, tolerance: float, *, cash_id: str = CASH.id_col,
                 rada_id: str = RADA.id_col, payload=(), rada_payload=()) -> DataFrame:
    """Records of equal ``business_key`` paired one-to-one by ``amount``: columns
    ``cash_id``, ``rada_id``, ``_cash_amount``, ``_rada_amount`` and the payloads."""
    pairs = _pairs(*_sides(cash, rada, cash_id, rada_id, payload, rada_payload), tolerance)
    return pairs.filter(f"{_IN_CASH} and {_IN_RADA}").drop("_in_cash", "_in_rada")


def status_expr(in_cash: Column, in_rada: Column, cash_amount: Column, rada_amount: Column,
                tolerance: float) -> Column:
    """One label per pair. The tolerance is inclusive, compared in decimals; an
    amount that is unknown cannot be shown to agree, so it is a mismatch."""
    apart = F.abs(exact(cash_amount) - exact(rada_amount))
    return (F.when(~in_cash, F.lit(NEW))
            .when(~in_rada, F.lit(UNMATCHED))
            .when(apart <= F.lit(repr(float(tolerance))).cast(MONEY), F.lit(MATCHED))
            .otherwise(F.lit(AMOUNT_MISMATCH)))


def reason_expr(status: Column) -> Column:
    """Why a record is an exception; NULL for MATCHED and CLEARED."""
    return (F.when(status == AMOUNT_MISMATCH, F.lit(REASON_AMOUNT))
            .when(status == UNMATCHED, F.lit(REASON_MISSING_IN_RADA))
            .when(status == NEW, F.lit(REASON_MISSING_IN_CASH)))


def _label(pairs: DataFrame, tolerance: float) -> DataFrame:
    s, in_cash, in_rada = F.col("recon_status"), F.expr(_IN_CASH), F.expr(_IN_RADA)
    variance = F.coalesce((exact(F.col("_cash_amount")) - exact(F.col("_rada_amount"))).cast("double"),
                          F.col("_cash_amount") - F.col("_rada_amount"))
    return (pairs.withColumn("recon_status", status_expr(in_cash, in_rada, F.col("_cash_amount"),
                                                         F.col("_rada_amount"), tolerance))
            .select(
                "business_key", "cash_id", "rada_id", "account_number", "trade_reference",
                "settlement_date", "currency",
                F.when(in_cash, F.col("_cash_amount")).otherwise(F.col("_rada_amount")).alias("amount"),
                F.when(in_cash & in_rada, F.col("_rada_amount")).alias("rada_amount"),
                F.when(in_cash & in_rada, variance).alias("amount_variance"),
                F.when(s != AMOUNT_MISMATCH, F.col("swift_bic")).alias("swift_bic"),
                "debit_credit", "recon_status", reason_expr(s).alias("mismatch_reason"),
            ))


def _cleared_rows(keys: DataFrame, like: DataFrame) -> DataFrame:
    """One CLEARED row per key."""
    return keys.select("business_key", *(
        (F.lit(CLEARED) if f.name == "recon_status" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields if f.name != "business_key"))


def classify(cash_keyed: DataFrame, rada_keyed: DataFrame, cfg: ReconConfig = ReconConfig(),
             *, cash_id: str = CASH.id_col, rada_id: str = RADA.id_col,
             previous_open: DataFrame | None = None) -> DataFrame:
    """Every record of both keyed ledgers, paired and labelled, in the gold row shape.

    ``previous_open``: business keys UNMATCHED in the earlier snapshot
    (repeats are fine). When given, one CLEARED row per such key that is not
    UNMATCHED today is added.
    """
    cash, rada = _sides(cash_keyed, rada_keyed, cash_id, rada_id)
    pairs, cleared = _match(cash, rada, cfg.amount_tolerance,
                            None if previous_open is None else previous_open.select("business_key"))
    out = _label(pairs, cfg.amount_tolerance)
    return out if cleared is None else out.unionByName(_cleared_rows(cleared, out))


# --- new records against open ones -----------------------------------------

def open_sides(open_pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of stored open pairs, as the two sides that ``match_open`` takes."""
    cash = open_pairs.filter(_IN_CASH).select("business_key", "cash_id", "_cash_amount", *CASH_PAYLOAD, "_in_cash")
    return cash, open_pairs.filter(_IN_RADA).select("business_key", "rada_id", "_rada_amount", "_in_rada")


def match_open(cash_new: DataFrame, rada_new: DataFrame, open_pairs: DataFrame | None,
               cfg: ReconConfig = ReconConfig()) -> tuple[DataFrame, DataFrame]:
    """(closed rows, open pairs) of new keyed records matched with what an earlier run left open.

    Closed are the MATCHED pairs, in the gold row shape; they are not looked at again. All
    other records stay open, AMOUNT_MISMATCH pairs included: ``label_open`` classifies them,
    and the next run matches them again. A new copy of an open record takes its
    place. Nothing but the arguments is read, and the pairs are stored once.
    """
    cash, rada = _sides(cash_new, rada_new, CASH.id_col, RADA.id_col)
    if open_pairs is not None:
        old_cash, old_rada = open_sides(open_pairs)
        cash = old_cash.join(cash.select("cash_id"), "cash_id", "left_anti").select(*cash.columns).unionByName(cash)
        rada = old_rada.join(rada.select("rada_id"), "rada_id", "left_anti").select(*rada.columns).unionByName(rada)
    pairs = stored(_pairs(cash, rada, cfg.amount_tolerance), "pairs")
    near = status_expr(F.expr(_IN_CASH), F.expr(_IN_RADA), F.col("_cash_amount"), F.col("_rada_amount"), cfg.amount_tolerance)
    return _label(pairs.filter(near == MATCHED), cfg.amount_tolerance), pairs.filter(near != MATCHED)


def label_open(open_pairs: DataFrame, cfg: ReconConfig = ReconConfig()) -> DataFrame:
    """Stored open pairs in the gold row shape."""
    return _label(open_pairs, cfg.amount_tolerance)


# --- per-class views (the public four-way split) -------------------------

def matched(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("recon_status") == MATCHED).select(*MATCHED_COLUMNS)


def unmatched(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("recon_status") == UNMATCHED).select(*UNMATCHED_COLUMNS)


def new(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("recon_status") == NEW).select(*NEW_COLUMNS)


def amount_mismatched(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("recon_status") == AMOUNT_MISMATCH).select(*MISMATCH_COLUMNS)


def reconcile(cash_keyed: DataFrame, rada_keyed: DataFrame, cfg: ReconConfig = ReconConfig(),
              *, materialize: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(matched, unmatched, new, amount_mismatched)`` over one classification.

    The four views prune different columns, so Spark cannot share one match
    between them: each would run it again. With ``materialize`` (default)
    the classification is stored once below the shared checkpoint folder
    and the views read the stored rows; the match runs exactly once.
    """
    c = classify(cash_keyed, rada_keyed, cfg)
    if materialize:
        c = stored(c, "classified")
    return matched(c), unmatched(c), new(c), amount_mismatched(c)
