"""Conversation repair against a forward search over (cost, edits)."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgermatch.llm import conversation_repair as repair
from ledgermatch.llm import queries

SF0001 = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, fp string, k long, seen string"
BLANK = " \t\n\x0b\x0c\r"


def tie(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if hit == 4 else role
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def best_edits(rows, must, cut):
    """The least (cost, edits) that reaches each written prefix class, row by row, forward."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(front):
        for _ in range(3):
            for last, (cost, edits, lines) in list(front.items()):
                role = {"u": "user", "a": "assistant"}[due[last]]
                new = (cost + 5, edits + "I", [*lines, f"{role}:"])
                if new[:2] < front.get(due[last], (1 << 60, ""))[:2]:
                    front[due[last]] = new
        return front

    front = insert({"": (0, "", [])})
    for (role, text), gone, torn in zip(rows, must, cut, strict=True):
        after = {}

        def offer(last, new, after=after):
            if last not in after or new[:2] < after[last][:2]:
                after[last] = new
        for last, (cost, edits, lines) in front.items():
            offer(last, (cost + 2, edits + "D", lines))
            if not gone:
                first = role[:1]
                if first == due[last] or first == "s" and last == "":
                    offer(first, (cost + 5 * torn, edits + "K", [*lines, f"{role}:{text}"]))
                name = {"u": "user", "a": "assistant"}[due[last]]
                offer(due[last], (cost + 1 + 5 * torn, edits + "R", [*lines, f"{name}:{text}"]))
        front = insert(after)
    return min((front[x] for x in ("", "a") if x in front), key=lambda x: x[:2])


def brute(rows):
    out = {}
    for conv, mine in damage(rows).items():
        mine = sorted(mine, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1], r[2])))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, counts, must, cut = set(), [0, 0, 0], [], []
        for _, role, text in mine:
            end = text.rstrip(BLANK)[-1:]
            kind = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                counts[kind] += 1
            must.append(kind in (0, 1))
            cut.append(kind == 2)
        pairs = [(r, t) for _, r, t in mine]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:], strict=False))
        cost, edits, lines = best_edits(pairs, must, cut)
        out[conv] = (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(seed, conversations, most):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        for _ in range(rng.randrange(1, most)):
            rows.append((conv if conv else None, rng.choice([None, *range(3 * most)]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "unknown"]),
                         rng.choice(["", " ", None, "yes.", "no", "a. b! c?", "why?\n", "é \U0001f600."]) if rng.random() < 0.4
                         else f"text {rng.random()}."))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def got(df):
    rows = df.collect()
    assert df.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 3}, {"chunk_bytes": 200}])
def test_repair_equals_the_forward_search(spark, options):
    rows = rows_of(1, 40, 30)
    assert got(repair.repair_damaged(frame(spark, rows), **options)) == brute(rows)


def test_one_long_conversation_over_many_chunks(spark):
    """Also runs in which no chunk's vectors converge: only blank rows, or one row repeated."""
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"t{i}." if rng.random() < 0.8 else "cut") for i in range(300)]
    rows += [(7, 300 + i, "user", "  ") for i in range(150)]
    rows += [(7, 450, "assistant", "again.")] * 120 + [(7, 451 + i, "user", f"and {i}") for i in range(40)] + [(8, 1, "user", "a.")]
    assert got(repair.repair_damaged(frame(spark, rows), chunk_rows=4)) == brute(rows)


def test_passes_grow_with_the_logarithm(spark, monkeypatch):
    """64 chunks that pass every difference on take no more than seven passes."""
    passes, ddl = [], repair._ddl

    def counting(columns):
        passes.extend([1] if columns is repair._VECTORS else [])  # a pass names the columns of the vectors
        return ddl(columns)
    monkeypatch.setattr(repair, "_ddl", counting)
    rows = [(1, i, "user", "") for i in range(128)] + [(1, 200, "user", "end.")]
    assert got(repair.repair_damaged(frame(spark, rows), chunk_rows=2)) == brute(rows)
    assert len(passes) <= 7


def test_vectors_rerun_in_step_with_the_former_run():
    rng = random.Random(9)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 5, 9, 10]) for _ in range(rng.randrange(1, 40)))
        old, new = repair.SPECULATIVE, repair._with_inserts([rng.randrange(9) for _ in range(4)])
        assert repair.rerun(codes, new, old, repair.costs(codes, old)[0]) == repair.costs(codes, new)[0]


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_conversation_repair(spark, SF0001)) == brute(rows)


def test_dropped_and_empty_conversations(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, turn, "user", "gone."), (6, 1, None, None), (None, None, None, None)]
    want = brute(rows)
    assert want[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(repair.repair_damaged(frame(spark, rows))) == want
    assert got(repair.repair_damaged(frame(spark, rows), chunk_rows=1)) == want
    assert repair.repair_damaged(frame(spark, rows).limit(0)).collect() == []


def test_very_long_texts(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], "w " * 200_000 + "." * (i % 3)) for i in range(6)]
    assert got(repair.repair_damaged(frame(spark, rows), chunk_bytes=1 << 19)) == brute(rows)
