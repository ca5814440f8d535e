"""Random small ledgers against the matching rules."""

from collections import defaultdict
from decimal import Decimal

from ledger_helpers import ledger_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgermatch.functions.keys import prepare_for_matching
from ledgermatch.operators import match

ACCOUNTS = ["A1", "A2", "A3"]
AMOUNTS = [100.0, 100.4, 100.5, 101.0, 101.01, 101.5, 102.2, 150.0, 1101.0, None]


def most_pairs(cash, rada, tol=Decimal("1.0")):
    """Size of a largest pairing within the tolerance, by augmenting paths."""
    partner = {}

    def place(i, tried):
        for j, r in enumerate(rada):
            if j not in tried and cash[i] is not None and r is not None and abs(cash[i] - r) <= tol:
                tried.add(j)
                if j not in partner or place(partner[j], tried):
                    partner[j] = i
                    return True
        return False
    return sum(place(i, set()) for i in range(len(cash)))


records = st.lists(st.tuples(st.sampled_from(ACCOUNTS), st.sampled_from(AMOUNTS)), max_size=9)


def classified(spark, cash_rows, rada_rows, open_before=()):
    """Result rows with their account, by the key function of the library."""
    c, r, snap = (prepare_for_matching(ledger_rows(spark, id_col, [
        (rid, acc, "T", "2026-01-01", "ZAR", amt, "D") for rid, acc, amt in rows]), id_col)
        for id_col, rows in (("cash_id", cash_rows), ("rada_id", rada_rows),
                             ("cash_id", [("S", acc, 1.0) for acc in sorted(open_before)])))
    key_to_acc = {row["business_key"]: row["account_number"] for row in
                  c.unionByName(r.withColumnRenamed("rada_id", "cash_id")).unionByName(snap)
                  .select("business_key", "account_number").collect()}
    return [(key_to_acc[g["business_key"]], g) for g in
            match.classify(c, r, previous_open=snap.select("business_key")).collect()]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cash=records, rada=records, open_before=st.sets(st.sampled_from(ACCOUNTS)))
def test_classify_keeps_the_rules(spark, cash, rada, open_before):
    """As many pairs within the tolerance as there can be, the rest by rank, each record
    once, whatever the identifiers."""
    cash_rows = [(f"C{i}", acc, amt) for i, (acc, amt) in enumerate(cash)]
    rada_rows = [(f"R{i}", acc, amt) for i, (acc, amt) in enumerate(rada)]
    got = classified(spark, cash_rows, rada_rows, open_before)
    amounts = {rid: (acc, None if amt is None else Decimal(str(amt))) for rid, acc, amt in cash_rows + rada_rows}
    ids = [g[k] for _, g in got for k in ("cash_id", "rada_id") if g[k] is not None]
    assert sorted(ids) == sorted(amounts)  # every record in exactly one row
    count, left = defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for acc, g in got:
        count[g["recon_status"]][acc] += 1
        if g["cash_id"] and g["rada_id"]:
            (a, x), (b, y) = amounts[g["cash_id"]], amounts[g["rada_id"]]
            near = x is not None and y is not None and abs(x - y) <= 1
            assert a == b == acc and near == (g["recon_status"] == "MATCHED")
            if not near:
                left[acc].append((x, y))
    for acc in ACCOUNTS:
        cs, rs = ([amounts[i][1] for i, a, _ in side if a == acc] for side in (cash_rows, rada_rows))
        pairs = min(len(cs), len(rs))
        assert count["MATCHED"][acc] == most_pairs(cs, rs)
        assert count["MATCHED"][acc] + count["AMOUNT_MISMATCH"][acc] == pairs
        assert (count["UNMATCHED"][acc], count["NEW"][acc]) == (len(cs) - pairs, len(rs) - pairs)
        unknown_last = [sorted(side, key=lambda x: (x is None, x or 0)) for side in zip(*left[acc], strict=True)]
        assert sorted(left[acc], key=lambda p: [(x is None, x or 0) for x in p]) == list(zip(*unknown_last, strict=True))
        assert bool(count["CLEARED"][acc]) == (acc in open_before and len(cs) <= len(rs))
    renamed = classified(spark, [(f"X{99 - i}", a, m) for i, (_, a, m) in enumerate(cash_rows)],
                         [(f"Y{99 - i}", a, m) for i, (_, a, m) in enumerate(rada_rows)])
    def facts(rows):
        return sorted(repr((acc, g["amount"], g["rada_amount"], g["recon_status"])) for acc, g in rows
                      if g["recon_status"] != "CLEARED")
    assert facts(renamed) == facts(got)


amount_runs = st.lists(st.tuples(st.integers(0, 60), st.integers(0, 3), st.integers(0, 3)), max_size=14)


@settings(max_examples=300, deadline=None)
@given(amount_runs)
def test_sweep_is_a_largest_pairing(spread):
    """``allot`` pairs as many as augmenting paths do, keeps equal amounts where that
    loses nothing, and numbers the records of an amount without gaps."""
    run = sorted({Decimal(a) / 5: (c, r) for a, c, r in spread if c + r}.items())
    rows = [(a, c, r) for a, (c, r) in run]
    facts = {f["_at"]: f for f in match.allot(rows, Decimal("1.0"))}
    best = most_pairs([a for a, c, _ in rows for _ in range(c)], [a for a, _, r in rows for _ in range(r)])
    assert sum(f["cash_paired"] for f in facts.values()) == sum(f["rada_paired"] for f in facts.values()) == best
    for a, c, r in rows:
        f = facts[a]
        assert f["cash_paired"] <= c and f["rada_paired"] <= r and f["equal"] in (0, min(c, r))
        for side in ("cash", "rada"):
            done = f["equal"]
            for to in f[f"{side}_to"]:
                assert to["after"] == done and abs(to["other"] - a) <= 1
                done += to["n"]
            assert done == f[f"{side}_paired"]
    rest = [(a, c - min(c, r), r - min(c, r)) for a, c, r in rows]
    kept = sum(min(c, r) for _, c, r in rows) + most_pairs(
        [a for a, c, _ in rest for _ in range(c)], [a for a, _, r in rest for _ in range(r)])
    assert (kept == best) == all(facts[a]["equal"] == min(c, r) for a, c, r in rows)


rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from([1, 2]),
                          st.integers(0, 9)), max_size=10)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_replace_groups_equals_model(spark, target, source):
    """Every (key, date) group present in the source replaces the target's
    rows of that group; all other target rows stay; applying it twice
    changes nothing."""
    from ledgermatch.operators.gold import replace_groups

    schema = "business_key string, _run_date int, v int"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    touched = {(k, d) for k, d, _ in source}
    expected = sorted([r for r in target if (r[0], r[1]) not in touched] + list(source))
    once = replace_groups(t, s)
    assert sorted(tuple(r) for r in once.collect()) == expected
    assert sorted(tuple(r) for r in replace_groups(once, s).collect()) == expected


copies = st.lists(st.tuples(st.sampled_from(["C1", "C2", "C3"]), st.sampled_from([1, 2, 3]),
                            st.sampled_from([None, "a", "b"]), st.sampled_from([None, 1.0, 2.5])), max_size=10)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=copies)
def test_latest_per_id_equals_model(spark, rows):
    """Survivor per id: the greatest (_ingested_ts, narrative, amount), NULL lowest."""
    import datetime as dt

    from ledgermatch.operators.standardise import latest_per_id

    base = dt.datetime(2026, 1, 1)
    data = [(i, base + dt.timedelta(hours=h), n, a) for i, h, n, a in rows]
    df = spark.createDataFrame(data, "cash_id string, _ingested_ts timestamp, narrative string, amount double")

    def rank(r):
        return tuple((0,) if v is None else (1, v) for v in r[1:])

    expected = {}
    for r in data:
        if r[0] not in expected or rank(r) > rank(expected[r[0]]):
            expected[r[0]] = r
    got = {r["cash_id"]: tuple(r) for r in latest_per_id(df, "cash_id").collect()}
    assert got == expected
