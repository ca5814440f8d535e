"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation's rows, by turn, are edited at least cost until its role initials
read ``(s?(ua)+)?``. Costs per row: Keep 0, Rerole (to the user or assistant
that is due) 1, Delete 2; an Insert of an empty user or assistant message anywhere
costs 5; a truncated row that is not deleted adds 5; blank and duplicate rows can
only be deleted. Of the cheapest edits the ASCII-least initials (D, I, K, R) win.

What is due depends on four states only (nothing yet, after s, after u, after
a), so the cost to the end is a vector of four numbers per position, computed from
the end backwards. Rows are range-partitioned and sorted by conversation and turn, and
a conversation is cut into chunks where a partition ends and after ``chunk_rows`` rows or
``chunk_bytes`` bytes. A conversation that lies within one chunk is finished in its task.
Chunks of the others:

1. all start at once from speculative cost vectors (zeros; the last chunk
   knows its own) and give the vector at their first row;
2. fix-up passes: a chunk whose speculation differs from the vector of the next chunk
   by more than a constant runs again, in step with its former run, and stops
   where the two differ by a constant only: all that lies before is right but for that
   constant. Pass p runs spans of 2^p neighbouring chunks one after the other in a task,
   so that chunks which pass every difference on (all rows blank) take a logarithmic
   number of passes. Passes end when no seam differs by more than a constant;
3. the constants of the seams are added up (stitched costs), each chunk tells in which
   state it would leave from each of the four, the chunks' entry states
   follow, and every chunk traces its least edits from its own.

Duplicates across chunks are found by the least chunk of a (conversation, digest of
role and text); a chunk sends each digest once. A repaired conversation is hashed
from its chunks' pieces, streamed in order: SHA-256 is sequential, so this
last step is one task per conversation, which holds one piece at a time.

Defined results: a null role or text is one space; a null turn comes first and counts for
no gap; a null conversation is one of its own; rows of one turn are ordered by
the SHA-256 of their role and text; an empty role is no legal role and is never kept;
repeated rows are duplicates; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import STRIP, cut

CHUNK_ROWS = 2048
CHUNK_BYTES = 4 << 20
# fixed values: costs of edits
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: states: 0 nothing yet, 1 after s, 2 after u, 3 after a; where the due role leads
DUE = (2, 2, 3, 2)
DUE_ROLE = ("user", "user", "assistant", "user")
#: where a kept row of each kind (s, u, a, other) leads from each state
KEPT = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
KINDS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
_MUST, _CUT = 4, 8  # flags beside the kind in a row's code: must be deleted, truncated
SPECULATIVE = [0, 0, 0, 0]

Vector = list[int]
Batches = Iterator[pa.RecordBatch]


# ---- one chunk ------------------------------------------------------------

def _with_inserts(w: Vector) -> Vector:
    after_u, after_a = min(w[2], INSERT + w[3]), min(w[3], INSERT + w[2])
    return [min(w[0], INSERT + after_u), min(w[1], INSERT + after_u), after_u, after_a]


#: the cost at the end of a conversation
FINAL = _with_inserts([0, 1 << 40, 1 << 40, 0])


def step_back(code: int, after: Vector) -> Vector:
    """The cost vector before a row, from the one behind it."""
    out = [DELETE + v for v in after]
    if not code & _MUST:
        extra = TRUNCATED if code & _CUT else 0
        kept = KEPT[code & 3]
        for s in range(4):
            cost = extra + REROLE + after[DUE[s]]
            if kept[s] is not None:
                cost = min(cost, extra + after[kept[s]])
            if cost < out[s]:
                out[s] = cost
    return _with_inserts(out)


def costs(codes: bytes, right: Vector) -> list[Vector]:
    """The vector at every position, the one behind the last row included."""
    out = [right]
    for code in reversed(codes):
        out.append(step_back(code, out[-1]))
    return out[::-1]


def constant(a: Vector, b: Vector) -> int | None:
    """``a - b`` if it is one number, else None."""
    apart = a[0] - b[0]
    return apart if all(x - y == apart for x, y in zip(a, b, strict=True)) else None


def rerun(codes: bytes, right: Vector, former_right: Vector, former_left: Vector) -> Vector:
    """The vector at the first row for another ``right``: runs in step with the
    former run until the two differ by a constant."""
    new, old = right, former_right
    for code in reversed(codes):
        if (apart := constant(new, old)) is not None:
            return [v + apart for v in former_left]
        new, old = step_back(code, new), step_back(code, old)
    return new


def trace(codes: bytes, at: list[Vector], state: int, last: bool) -> tuple[str, int]:
    """(initials of the least cheapest edits, the state after them)."""
    out, i, n = [], 0, len(codes)
    while i < n or last and state not in (0, 3):
        cost, due = at[i][state], DUE[state]
        if i < n and DELETE + at[i + 1][state] == cost:
            edit, i = "D", i + 1
        elif INSERT + at[i][due] == cost:
            edit, state = "I", due
        else:
            extra, kept = TRUNCATED if codes[i] & _CUT else 0, KEPT[codes[i] & 3][state]
            if kept is not None and extra + at[i + 1][kept] == cost:
                edit, state = "K", kept
            else:
                edit, state = "R", due
            i += 1
        out.append(edit)
    return "".join(out), state


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The lines that the edits leave."""
    out, i = [], 0
    for edit in audit:
        if edit == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state = KEPT[KINDS[roles[i][:1]]][state]
        elif edit != "D":
            out.append(f"{DUE_ROLE[state]}:{texts[i] if edit == 'R' else ''}")
            state = DUE[state]
        i += edit != "I"
    return out


def coded(roles: list[str], texts: list[str], duplicate: list[bool]) -> tuple[bytes, list[int]]:
    """(a code per row, [blank, duplicate, truncated, illegal]); each row's first fault counts."""
    faults, codes = [0, 0, 0, 0], bytearray()
    for role, text, again in zip(roles, texts, duplicate, strict=True):
        code, end = KINDS.get(role[:1], 3), text.rstrip(STRIP)[-1:]
        if not end or again:
            faults[0 if not end else 1] += 1
            code |= _MUST
        elif end not in ".!?":
            faults[2] += 1
            code |= _CUT
        codes.append(code)
    faults[3] = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
    return bytes(codes), faults


def first_seen(keys: list[bytes], before: set[bytes]) -> list[bool]:
    """Whether each key was seen in ``before`` or earlier in the list."""
    seen, out = set(before), []
    for key in keys:
        out.append(key in seen)
        seen.add(key)
    return out


# ---- rows -> chunks -------------------------------------------------------

_RESULT = {"gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(),
           "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}
_CHUNK = {"chunk": pa.int64(), "first_turn": pa.int64(), "last_turn": pa.int64(), "turns": pa.int64(),
          "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "keys": pa.list_(pa.binary())}


def _ddl(columns: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean",
             pa.list_(pa.string()): "array<string>", pa.list_(pa.binary()): "array<binary>", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{c} {names[t]}" for c, t in columns.items())


class _Chunk:
    """Rows of one conversation, in order."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.size = conv, number, 0
        self.turns, self.roles, self.texts, self.keys = [], [], [], []

    def add(self, turn, role: str, text: str, key: bytes, present: bool) -> None:
        if present:
            self.size += len(text) + len(role) + 64
            self.roles.append(role)
            self.texts.append(text)
            self.keys.append(key)
            if turn is not None and (not self.turns or self.turns[-1] != turn):
                self.turns.append(turn)

    def full(self, rows: int, size: int) -> bool:
        return len(self.roles) >= rows or self.size >= size

    def gaps(self) -> int:
        return self.turns[-1] - self.turns[0] + 1 - len(self.turns) if self.turns else 0

    def finished(self) -> dict:
        codes, faults = coded(self.roles, self.texts, first_seen(self.keys, set()))
        at = costs(codes, FINAL)
        audit, _ = trace(codes, at, 0, True)
        lines = "\n".join(repaired(audit, 0, self.roles, self.texts))
        return {"conv_id": self.conv, "gaps": self.gaps(), "blank": faults[0], "duplicate": faults[1],
                "truncated": faults[2], "illegal": faults[3], "cost": at[0][0], "audit": audit,
                "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}

    def open(self) -> dict:
        return {"conv_id": self.conv, "chunk": self.number, "first_turn": self.turns[0] if self.turns else None,
                "last_turn": self.turns[-1] if self.turns else None, "turns": len(self.turns), "roles": self.roles,
                "texts": self.texts, "keys": self.keys}


def _chunks(chunk_rows: int, chunk_bytes: int):
    """Sorted rows -> a result per conversation that lies within the partition,
    a row per chunk of the others."""
    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        number, kind = TaskContext.get().partitionId() << 32, None
        now, edge, out, held = None, True, [], 0  # edge: what ``now`` holds may have begun in the partition before

        def batch() -> pa.RecordBatch:
            kinds = {"conv_id": kind, **_RESULT, **_CHUNK}
            return pa.RecordBatch.from_arrays([pa.array([x.get(c) for x in out], t) for c, t in kinds.items()], names=list(kinds))

        for rows in batches:
            kind = rows.schema.field("conv_id").type
            for conv, turn, key, role, text, present in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if now is not None and now.conv != conv:
                    out.append(now.open() if edge else now.finished())
                    now, edge = _Chunk(conv, now.number + 1), False
                elif now is not None and now.full(chunk_rows, chunk_bytes):
                    out.append(now.open())
                    now, edge = _Chunk(conv, now.number + 1), True
                now = now or _Chunk(conv, number)
                now.add(turn, role, text, key, present)
                held += len(text)
                if len(out) >= 5000 or held >= chunk_bytes and out:
                    yield batch()
                    out, held = [], 0
        if now is not None:  # the conversation may go on in the next partition
            out.append(now.open())
            yield batch()
    return run


# ---- chunks -> vectors, states, pieces ------------------------------------

def _mapped(make: Callable[[dict], dict], columns: dict[str, pa.DataType]):
    """Row-wise map of chunk rows, each Arrow batch cut to a few rows."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                rows = [make(x) for x in batch.slice(at, 16).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in columns.items()],
                                                 names=list(columns))
    return run


_VECTORS = {"_c": pa.string(), "k": pa.int64(), "last": pa.bool_(), "codes": pa.binary(), "right": pa.list_(pa.int64()),
            "left": pa.list_(pa.int64())}
_CODED = {**_VECTORS, "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(),
          "opens": pa.string(), "closes": pa.string()}


def _speculate(x: dict) -> dict:
    codes, faults = coded(x["roles"], x["texts"], first_seen(x["keys"], set(x["seen"] or ())))
    right = FINAL if x["last"] else SPECULATIVE
    return {**x, "codes": codes, "right": right, "left": costs(codes, right)[0], "blank": faults[0], "duplicate": faults[1],
            "truncated": faults[2], "illegal": faults[3], "opens": x["roles"][0][:1], "closes": x["roles"][-1][:1]}


def _fix_up(table: pa.Table) -> pa.Table:
    """A span of neighbouring chunks, from its last to its first."""
    rows = sorted(table.to_pylist(), key=lambda x: -x["k"])
    coming = rows[0]["coming"]  # the vector of the chunk behind the span; None behind the last chunk
    for x in rows:
        if coming is not None:
            x["left"] = rerun(x["codes"], coming, x["right"], x["left"])
            x["right"] = coming
        coming = x["left"]
    return pa.table({c: pa.array([x[c] for x in rows], t) for c, t in _VECTORS.items()})


_EXITS = {"_c": pa.string(), "k": pa.int64(), "exits": pa.list_(pa.int64())}


def _exits(x: dict) -> dict:
    at = costs(x["codes"], x["right"])
    return {**x, "exits": [trace(x["codes"], at, s, x["last"])[1] for s in range(4)]}


def _entries(table: pa.Table) -> pa.Table:
    """The state in which each chunk of a conversation is entered."""
    rows, state, out = sorted(table.to_pylist(), key=lambda x: x["k"]), 0, []
    for x in rows:
        out.append(state)
        state = x["exits"][state]
    return pa.table({"_c": pa.array([x["_c"] for x in rows]), "k": pa.array([x["k"] for x in rows], pa.int64()),
                     "entry": pa.array(out, pa.int64())})


_PIECES = {"_c": pa.string(), "k": pa.int64(), "audit": pa.string(), "piece": pa.binary()}


def _piece(x: dict) -> dict:
    audit, _ = trace(x["codes"], costs(x["codes"], x["right"]), x["entry"], x["last"])
    return {**x, "audit": audit, "piece": "\n".join(repaired(audit, x["entry"], x["roles"], x["texts"])).encode()}


def _hashes(batches: Batches) -> Batches:
    """Sorted pieces -> the hash of each conversation, one piece at a time."""
    now, digest, empty = None, None, True

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["_c", "repaired_sha256"])

    for batch in batches:
        for conv, piece in zip(batch.column("_c"), batch.column("piece"), strict=True):
            conv, piece = conv.as_py(), piece.as_py()
            if conv != now:
                if now is not None:
                    yield done()
                now, digest, empty = conv, hashlib.sha256(), True
            if piece:
                digest.update(piece if empty else b"\n" + piece)
                empty = False
    if now is not None:
        yield done()


def _normal(vector: str) -> Column:
    """A vector without its constant."""
    return F.transform(vector, lambda v: v - F.element_at(vector, 1))


def _converged(vectors: DataFrame) -> DataFrame:
    """Vectors whose right ends agree with the next chunk's left ends but for constants."""
    order = Window.partitionBy("_c").orderBy("k")
    span = 1
    while True:
        # narrow rows: the next chunk's vector beside each chunk's own
        coming = vectors.select("_c", "k", F.lead("left").over(order).alias("coming"), "right")
        wrong = cut(coming.filter((_normal("coming") != _normal("right"))).select("_c", "k", "coming"))
        if wrong.isEmpty():
            return vectors
        span *= 2
        spans = wrong.select("_c", F.floor(F.col("k") / span).alias("_span")).distinct()
        marked = vectors.withColumn("_span", F.floor(F.col("k") / span))
        again = (marked.join(spans, ["_c", "_span"]).join(coming.select("_c", "k", "coming"), ["_c", "k"])
                 .groupBy("_c", "_span").applyInArrow(_fix_up, _ddl(_VECTORS)))
        vectors = cut(marked.join(spans, ["_c", "_span"], "left_anti").select(*_VECTORS).unionByName(again))


def _stitched(chunks: DataFrame) -> DataFrame:
    """Results of the conversations that are in several chunks or at a partition's edge."""
    named = chunks.withColumn("_c", F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")))
    order = Window.partitionBy("_c").orderBy("chunk")
    numbers = named.filter(F.size("roles") > 0).select(
        "_c", "chunk", (F.row_number().over(order) - 1).cast("long").alias("k"), F.lead("chunk").over(order).isNull().alias("last"),
        F.lag("last_turn").over(order).alias("turn_before"))
    chunks = cut(named.join(numbers, ["_c", "chunk"]))
    keys = chunks.select("_c", "k", F.explode(F.array_distinct("keys")).alias("key"))
    firsts = keys.groupBy("_c", "key").agg(F.min("k").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    seen = keys.join(firsts, ["_c", "key"]).filter("first < k").groupBy("_c", "k").agg(F.collect_list("key").alias("seen"))
    code = cut(chunks.select("_c", "k", "last", "roles", "texts", "keys").join(seen, ["_c", "k"], "left").mapInArrow(
        _mapped(_speculate, _CODED), _ddl(_CODED)))
    vectors = _converged(code.select(*_VECTORS))
    entries = vectors.mapInArrow(_mapped(_exits, _EXITS), _ddl(_EXITS)).groupBy("_c").applyInArrow(
        _entries, "_c string, k long, entry long")
    pieces = cut(chunks.select("_c", "k", "roles", "texts").join(vectors, ["_c", "k"]).join(entries, ["_c", "k"]).mapInArrow(
        _mapped(_piece, _PIECES), _ddl(_PIECES)))
    hashes = pieces.select("_c", "k", "piece").repartition("_c").sortWithinPartitions("_c", "k").mapInArrow(
        _hashes, "_c string, repaired_sha256 string")
    audits = pieces.groupBy("_c").agg(F.expr("listagg(audit) within group (order by k)").alias("audit"))
    by_k = Window.partitionBy("_c").orderBy("k")
    seams = code.select("_c", "k", "blank", "duplicate", "truncated", "illegal",
                        (~F.concat("closes", F.lead("opens").over(by_k)).isin(*LEGAL)).cast("long").alias("seam"))
    faults = seams.groupBy("_c").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
                                     (F.sum("illegal") + F.coalesce(F.sum("seam"), F.lit(0))).alias("illegal"))
    start = F.element_at("left", 1)
    constants = vectors.select("_c", "k", start.alias("left"), (F.lead(start).over(by_k) - F.element_at("right", 1)).alias("apart"))
    cost = constants.groupBy("_c").agg((F.sum(F.when(F.col("k") == 0, F.col("left")))
                                        + F.coalesce(F.sum("apart"), F.lit(0))).alias("cost"))
    again = (F.col("turn_before") == F.col("first_turn")).cast("long")
    turns = chunks.groupBy("_c").agg(F.coalesce(
        F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - F.coalesce(again, F.lit(0))), F.lit(0)).alias("gaps"))
    out = named.groupBy("_c").agg(F.max("conv_id").alias("conv_id"))
    for part in (turns, faults, cost, audits, hashes):
        out = out.join(part, "_c", "left")
    return out.fillna({"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                       "repaired_sha256": hashlib.sha256().hexdigest()}).select("conv_id", *_RESULT)


# ---- the operator ---------------------------------------------------------

def repair(rows: DataFrame, present: Column | None = None, chunk_rows: int = CHUNK_ROWS,
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``,
    ``repaired_sha256``. Rows that are not ``present`` only name their conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    # equal for equal (role, text) only: the role's length tells where the text begins
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    place = ["conv_id", "turn", "_key", "_row"]
    ordered = (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), key.alias("_key"), role.alias("_role"),
                           text.alias("_text"), (F.lit(True) if present is None else present).alias("_present"))
               .withColumn("_row", F.monotonically_increasing_id())  # parts rows that are equal in all else
               .repartitionByRange(*place).sortWithinPartitions(*place).drop("_row"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    path = scratch_path(rows.sparkSession, "conversations")
    ordered.mapInArrow(_chunks(chunk_rows, chunk_bytes),
                       f"conv_id {kind}, {_ddl(_RESULT)}, {_ddl(_CHUNK)}").write.parquet(path)
    table = rows.sparkSession.read.parquet(path)
    finished = table.filter("chunk is null").select("conv_id", *_RESULT)
    return finished.unionByName(_stitched(table.filter("chunk is not null").select("conv_id", *_CHUNK)))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: by CRC-32 of ``conv_id:turn`` modulo 20, 0
    drops a row (``present`` is false), 1 empties its text, 2 removes the sentence ends,
    3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    hit = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                               (F.crc32(name.cast("binary")) % 20).alias("_hit"))
    return hit.select(
        "conv_id", "turn", F.when(F.col("_hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("_hit") != 0).alias("present"),
        F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    ).drop("_copy")


def repair_damaged(conversations: DataFrame, **options) -> DataFrame:
    """``repair`` of the damaged rows, for every original conversation."""
    return repair(damaged(conversations), F.col("present"), **options)
