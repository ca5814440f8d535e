"""Field-level breaks against a brute-force search."""

import random
from decimal import Decimal

from ledger_helpers import ledger_rows

from ledgermatch.config import KEY_FIELDS
from ledgermatch.functions.keys import prepare_for_matching
from ledgermatch.operators import field_breaks, match

FIELD_AT = {"account_number": 1, "trade_reference": 2, "settlement_date": 3, "currency": 4, "debit_credit": 6}


def found(spark, cash, rada):
    c, r = ledger_rows(spark, "cash_id", cash), ledger_rows(spark, "rada_id", rada)
    out = match.classify(prepare_for_matching(c, "cash_id"), prepare_for_matching(r, "rada_id")).checkpoint()
    return out.collect(), field_breaks.field_breaks(out, c, r).collect()


def test_each_field_is_named_with_both_values(spark):
    base = ("ACC1", "TRD1", "2026-05-05", "ZAR", 10.0, "D")
    other = {"account_number": "ACC2", "trade_reference": "TRD9", "settlement_date": "2026-05-06", "currency": "USD", "debit_credit": "C"}
    for i, (field, value) in enumerate(other.items()):
        row = list(base)
        row[FIELD_AT[field] - 1] = value
        _, rows = found(spark, [(f"C{i}", *base)], [(f"R{i}", *row[:4], 10.4, row[5])])
        assert [tuple(x) for x in rows] == [(f"C{i}", f"R{i}", field, base[FIELD_AT[field] - 1], value, 10.0, 10.4)]
    _, rows = found(spark, [("C", *base)], [("R", *base[:4], 99.0, "D")])
    assert [tuple(x) for x in rows] == [("C", "R", "amount", "10.000000", "99.000000", 10.0, 99.0)]
    _, rows = found(spark, [("C", *base)], [("R", "ACC2", "TRD1", "2026-05-05", "USD", 10.0, "D")])
    assert rows == []  # two fields differ
    _, rows = found(spark, [("C", *base)], [("R", "ACC2", *base[1:4], 11.5, "D")])
    assert rows == []  # beyond the tolerance


def test_breaks_are_one_to_one_and_maximal(spark):
    """Random ledgers: every break is right, no record twice, and no two free records could form one
    that its block's pairing holds."""
    rng = random.Random(4)
    def row(prefix, i):
        return (f"{prefix}{i}", rng.choice(["A", "B"]), rng.choice(["T", "U"]), rng.choice(["2026-01-01", "2026-01-02"]),
                rng.choice(["ZAR", "USD"]), rng.choice([1.0, 1.5, 2.4, 9.0]), rng.choice("DC"))
    cash, rada = [row("C", i) for i in range(40)], [row("R", i) for i in range(25)]
    classes, rows = found(spark, cash, rada)
    by_id = {r[0]: r for r in cash + rada}
    open_ids = {x for r in classes for x in (r["cash_id"], r["rada_id"]) if x and r["recon_status"] in ("UNMATCHED", "NEW")}
    breaks = [r for r in rows if r["field"] != "amount"]
    ids = [x for r in breaks for x in (r["cash_id"], r["rada_id"])]
    assert breaks and len(ids) == len(set(ids)) and set(ids) <= open_ids
    for r in breaks:
        c, d = by_id[r["cash_id"]], by_id[r["rada_id"]]
        differ = [f for f in KEY_FIELDS if c[FIELD_AT[f]] != d[FIELD_AT[f]]]
        assert differ == [r["field"]] and (r["cash_value"], r["rada_value"]) == (c[FIELD_AT[differ[0]]], d[FIELD_AT[differ[0]]])
        assert abs(Decimal(str(c[5])) - Decimal(str(d[5]))) <= 1
    c, r = ledger_rows(spark, "cash_id", [x for x in cash if x[0] in open_ids]), ledger_rows(
        spark, "rada_id", [x for x in rada if x[0] in open_ids])
    for e in field_breaks.candidates(c, r).collect():  # greedy by one order: an edge left out lost to a better one
        if (e["cash_id"], e["rada_id"]) not in {(b["cash_id"], b["rada_id"]) for b in breaks}:
            better = [b for b in breaks if b["cash_id"] == e["cash_id"] or b["rada_id"] == e["rada_id"]]
            assert better and min(abs(b["amount"] - b["rada_amount"]) for b in better) <= abs(e["amount"] - e["rada_amount"])


def test_a_hot_block_stays_linear(spark):
    """Hundreds of open records that differ in the trade reference only: one break per pair, not all pairs."""
    cash = [(f"C{i}", "A", f"T{i}", "2026-01-01", "ZAR", 5.0, "D") for i in range(300)]
    rada = [(f"R{i}", "A", f"U{i}", "2026-01-01", "ZAR", 5.0, "D") for i in range(200)]
    _, rows = found(spark, cash, rada)
    assert len(rows) == 200 == len({r["cash_id"] for r in rows}) == len({r["rada_id"] for r in rows})
    assert {r["field"] for r in rows} == {"trade_reference"}


def test_nothing_open(spark):
    row = ("A", "T", "2026-01-01", "ZAR", 5.0, "D")
    assert found(spark, [("C", *row)], [("R", *row)])[1] == []
    assert found(spark, [], [])[1] == []
