"""Incremental silver and matching of new with open records."""

import os
import re

from ledger_helpers import SF0001, ledger_rows

from ledgermatch.config import CASH, RADA
from ledgermatch.functions.keys import prepare_for_matching
from ledgermatch.operators import match
from ledgermatch.operators.standardise import standardise
from ledgermatch.plans import queries as Q
from ledgermatch.plans import steps
from ledgermatch.sources import fixtures as fx
from ledgermatch.streaming.silver import apply_batch


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_batches_equal_a_rebuild_and_replays_change_nothing(spark, workdir):
    silver, quarantine = f"{workdir}/silver", f"{workdir}/quarantine"
    days = fx.dirty_cash_days(spark, SF0001)
    for i, day in enumerate(days):
        apply_batch(day, i, CASH, silver, quarantine, buckets=8)
    whole = standardise(fx.dirty_cash_bronze(spark, SF0001), CASH)
    want, rejects = rows_of(whole.clean.select(*Q.LEDGER_OUT)), rows_of(whole.quarantine.select(*Q.LEDGER_OUT))
    for replay in (None, 2, 0):
        if replay is not None:
            apply_batch(days[replay], replay, CASH, silver, quarantine, buckets=8)
        assert rows_of(spark.read.parquet(silver).select(*Q.LEDGER_OUT)) == want
        assert rows_of(spark.read.parquet(quarantine).select(*Q.LEDGER_OUT)) == rejects


def test_a_batch_that_failed_half_way_is_repaired(spark, workdir):
    """Rows that an append already left are merged, not doubled."""
    silver, quarantine = f"{workdir}/silver", f"{workdir}/quarantine"
    day = fx.dirty_cash_days(spark, SF0001)[0]
    apply_batch(day.sample(0.4, seed=3), 0, CASH, silver, quarantine, buckets=8)
    apply_batch(day, 0, CASH, silver, quarantine, buckets=8)
    assert rows_of(spark.read.parquet(silver).select(*Q.LEDGER_OUT)) == rows_of(standardise(day, CASH).clean.select(*Q.LEDGER_OUT))


def test_only_buckets_with_resent_ids_are_rewritten(spark, workdir):
    silver, quarantine = f"{workdir}/silver", f"{workdir}/quarantine"
    day = fx.cash_bronze(spark, SF0001, whole=True)
    apply_batch(day, 0, CASH, silver, quarantine, buckets=64)
    before = files(silver)
    resent = day.limit(2)
    done = apply_batch(resent, 1, CASH, silver, quarantine, buckets=64)
    after = files(silver)
    gone = {f.split("_bucket=")[1].split("/")[0] for f in before if after.get(f) != before[f]}
    assert 1 <= done["replaced"] <= 2 and done["appended"] == 0 and len(gone) == done["replaced"]
    new = fx.rada_bronze(spark, SF0001).limit(3).withColumnRenamed("rada_id", "cash_id")
    before = files(silver)
    assert apply_batch(new, 2, CASH, silver, quarantine, buckets=64)["replaced"] == 0
    assert before.items() <= files(silver).items()  # appended only


def test_stream_takes_new_bronze_files_only(spark, workdir):
    bronze, silver = f"{workdir}/bronze", f"{workdir}/silver"
    total = 0
    for day in fx.dirty_cash_days(spark, SF0001)[:2]:
        day.write.mode("append").parquet(bronze)
        steps.standardise_increment(spark, CASH, bronze, silver, f"{workdir}/quarantine", f"{workdir}/checkpoint", buckets=4)
        count = spark.read.parquet(silver).count()
        assert count > total
        total = count
    before = files(silver)
    steps.standardise_increment(spark, CASH, bronze, silver, f"{workdir}/quarantine", f"{workdir}/checkpoint", buckets=4)
    assert files(silver) == before


def frames(spark, cash, rada):
    return ledger_rows(spark, "cash_id", cash), ledger_rows(spark, "rada_id", rada)


def test_days_of_new_records_equal_one_match(spark, workdir):
    k = ("T", "2026-01-01", "ZAR")
    cash = [("C1", "A", *k, 10.0, "D"), ("C2", "B", *k, 20.0, "D"), ("C3", "D", *k, 5.0, "D"), ("C4", "E", *k, 7.0, "D")]
    rada = [("R1", "A", *k, 10.2, "D"), ("R2", "B", *k, 29.0, "D"), ("R3", "F", *k, 5.0, "D"), ("R4", "E", *k, 7.0, "D")]
    closed, still_open = f"{workdir}/closed", f"{workdir}/open"
    for day, (c, r) in enumerate([(cash[:2], rada[2:]), (cash[2:], rada[:1]), ([], rada[1:2])], 1):
        for _ in range(2):  # a repeated day changes nothing
            steps.reconcile_increment(spark, *frames(spark, c, r), closed, still_open, f"2026-01-0{day}")
    got = steps.incremental_classification(spark, closed, still_open, "2026-01-03")
    c, r = frames(spark, cash, rada)
    whole = match.classify(prepare_for_matching(c, "cash_id"), prepare_for_matching(r, "rada_id"))
    assert rows_of(got) == rows_of(whole.select(*got.columns))


def test_an_open_mismatch_is_matched_again_and_a_new_copy_replaces_it(spark, workdir):
    k, paths = ("A", "T", "2026-01-01", "ZAR"), (f"{workdir}/closed", f"{workdir}/open")
    def status(day):
        rows = steps.incremental_classification(spark, *paths, day).collect()
        return {(r["cash_id"], r["rada_id"], r["recon_status"]) for r in rows}
    steps.reconcile_increment(spark, *frames(spark, [("C1", *k, 10.0, "D")], [("R1", *k, 50.0, "D")]), *paths, "2026-01-01")
    assert status("2026-01-01") == {("C1", "R1", "AMOUNT_MISMATCH")}
    steps.reconcile_increment(spark, *frames(spark, [], [("R2", *k, 10.5, "D")]), *paths, "2026-01-02")
    assert status("2026-01-02") == {("C1", "R2", "MATCHED"), (None, "R1", "NEW")}
    steps.reconcile_increment(spark, *frames(spark, [("C2", *k, 30.0, "D")], [("R1", *k, 30.4, "D")]), *paths, "2026-01-03")
    assert status("2026-01-03") == {("C1", "R2", "MATCHED"), ("C2", "R1", "MATCHED")}


def test_a_run_reads_new_records_and_one_partition_of_open_pairs(spark, workdir):
    k, paths = ("T", "2026-01-01", "ZAR"), (f"{workdir}/closed", f"{workdir}/open")
    for day in (1, 2):
        steps.reconcile_increment(spark, *frames(spark, [(f"C{day}", f"A{day}", *k, 1.0, "D")], [(f"R{day}", f"B{day}", *k, 1.0, "D")]),
                                  *paths, f"2026-01-0{day}")
    read = steps.latest_before(spark, paths[1], "2026-01-03")
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*_run_date#\d+ = 2026-01-02", plan)
    match_plan = spark._jvm.PythonSQLUtils.explainString(
        match.open_sides(read)[0]._jdf.queryExecution(), "formatted")
    assert set(re.findall(r"Location: \w+ \[file:([^\]]*)\]", match_plan)) == {paths[1]}
    assert RADA.id_col in steps.latest_before(spark, paths[1], "2026-01-03").columns
    assert steps.latest_before(spark, paths[1], "2026-01-01") is None
