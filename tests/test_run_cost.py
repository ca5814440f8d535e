"""What a run shuffles and stores: ids that came once are not dealt, ledgers are not counted twice."""

import datetime as dt

import pytest
from test_repeated_keys import ledgers

from ledgermatch.operators import gold, match, standardise
from ledgermatch.sinks import tables


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def deliveries(spark, again):
    """Ten ids; those below ``again`` came three times, and a null id twice."""
    rows = [(f"id {i}", i, "first") for i in range(10)] + [(f"id {i}", i + n, "later") for i in range(again) for n in (1, 2)]
    rows += [(None, 1, "x"), (None, 2, "y")] if again else []
    return spark.createDataFrame(rows, "cash_id string, _ingested_ts int, narrative string")


def test_ids_that_came_once_are_not_shuffled(spark):
    """F3 to F22: each ledger's whole rows were sorted and dealt by id, twice and more a run."""
    once = standardise.latest_per_id(deliveries(spark, 0), "cash_id")
    assert "Exchange" not in _plan(once) and once.count() == 10


@pytest.mark.parametrize("listed", [100_000, 2])
def test_repeated_ids_keep_their_latest(spark, monkeypatch, listed):
    monkeypatch.setattr(standardise, "_LISTED", listed)
    got = {r["cash_id"]: (r["_ingested_ts"], r["narrative"]) for r in standardise.latest_per_id(deliveries(spark, 4), "cash_id").collect()}
    assert got == {**{f"id {i}": (i + 2, "later") for i in range(4)}, **{f"id {i}": (i, "first") for i in range(4, 10)}, None: (2, "y")}


def test_cleared_keys_take_no_second_count(spark):
    """The ledgers were counted again for the CLEARED rows; the plan now has the join's exchanges only."""
    cash, rada = (side.filter("business_key is not null").dropDuplicates(["business_key"]) for side in ledgers(spark))
    before = spark.createDataFrame([("key 1",), ("key 1",), ("gone",)], "business_key string")
    first = match.classify(cash, rada)
    with_cleared = match.classify(cash, rada, previous_open=before)
    assert _plan(with_cleared).count("Exchange hashpartitioning") == _plan(first).count("Exchange hashpartitioning")
    cleared = sorted(r["business_key"] for r in with_cleared.filter("recon_status = 'CLEARED'").collect())
    unpaired = {r["business_key"] for r in first.filter("recon_status = 'UNMATCHED'").collect()}
    assert cleared == sorted({"key 1", "gone"} - unpaired)


def test_replacing_groups_joins_their_run_dates_only(spark):
    """rows of other run dates were dealt by key too."""
    day, other = dt.date(2026, 1, 8), dt.date(2026, 1, 1)
    target = spark.createDataFrame([("a", day, 1), ("b", day, 2), ("a", other, 3), ("a", None, 4), (None, day, 5)],
                                   "business_key string, _run_date date, n int")
    source = spark.createDataFrame([("a", day, 9)], target.schema)
    rows = gold.replace_groups(target, source)
    assert sorted(r["n"] for r in rows.collect()) == [2, 3, 4, 5, 9]
    none = gold.replace_groups(target, source.limit(0))
    assert none.count() == 5


def test_joined_rows_are_stored_without_a_shuffle(spark, workdir):
    rows = spark.createDataFrame([(1, dt.date(2026, 1, 8))], "n int, _run_date date")
    tables.overwrite_partitions(rows, f"{workdir}/gold", rebalance=False)
    assert spark.read.parquet(f"{workdir}/gold").count() == 1
