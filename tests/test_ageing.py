"""Ageing of open items: carried forward and from the whole history."""

import random

from ledgermatch.operators import ageing
from ledgermatch.plans import steps

SCHEMA = "business_key string, recon_status string, _run_date date"
DAYS = ["2026-01-01", "2026-01-08", "2026-01-15", "2026-02-20"]


def gold(spark, rows):
    import datetime as dt

    return spark.createDataFrame([(k, s, dt.date.fromisoformat(d)) for k, s, d in rows], SCHEMA)


def facts(df):
    return sorted(((r["business_key"] or "", r["open_records"], str(r["first_open"]), r["runs_open"], r["days_open"], r["age_class"])
                   for r in df.collect()))


def test_gaps_start_anew_and_copies_count(spark):
    rows = [("a", "UNMATCHED", d) for d in DAYS] + [("b", "NEW", DAYS[0]), ("b", "MATCHED", DAYS[1]), ("b", "NEW", DAYS[2]),
            ("b", "AMOUNT_MISMATCH", DAYS[3]), ("c", "UNMATCHED", DAYS[3]), ("c", "UNMATCHED", DAYS[3]), ("d", "UNMATCHED", DAYS[2]),
            ("d", "CLEARED", DAYS[3]), (None, "NEW", DAYS[2]), (None, "NEW", DAYS[3])]
    want = [("", 1, DAYS[2], 2, 36, "30 days and more"), ("a", 1, DAYS[0], 4, 50, "30 days and more"),
            ("b", 1, DAYS[2], 2, 36, "30 days and more"), ("c", 2, DAYS[3], 1, 0, "under 7 days")]
    history = gold(spark, rows)
    assert facts(ageing.from_history(history)) == want
    aged = None
    for day in DAYS:
        aged = ageing.carry_forward(aged, history.filter(f"_run_date = '{day}'"), day)
    assert facts(aged) == want


def test_stored_runs_equal_the_history(spark, workdir):
    """Also with a run in which nothing is open, and with a run repeated."""
    rng = random.Random(2)
    rows = [(f"k{i}", rng.choice(["UNMATCHED", "NEW", "AMOUNT_MISMATCH", "MATCHED"]), d) for i in range(30) for d in DAYS
            if rng.random() < 0.8]
    for skipped in (None, DAYS[1]):
        path = f"{workdir}/{skipped}"
        kept = [(k, "MATCHED" if d == skipped else s, d) for k, s, d in rows]
        gold(spark, kept).write.partitionBy("_run_date").parquet(f"{path}/gold")
        for day in [*DAYS, DAYS[-1]]:
            steps.age_open_items(spark, f"{path}/gold", f"{path}/ageing", day)
        got = spark.read.parquet(f"{path}/ageing").filter(f"_run_date = '{DAYS[-1]}'")
        assert facts(got) == facts(ageing.from_history(gold(spark, kept)))


def test_no_history(spark):
    assert ageing.from_history(gold(spark, [])).collect() == []
    assert ageing.carry_forward(None, gold(spark, []), DAYS[0]).collect() == []
