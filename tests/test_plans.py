"""Physical-plan properties the scale design relies on."""

import re

import pytest
from ledger_helpers import SF0001

from ledgermatch.operators import kpis, match
from ledgermatch.operators.cleared import snapshot_open_keys
from ledgermatch.plans import queries as Q


def _plan(df) -> str:
    """The full ``explain("formatted")`` text."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _exchanges(plan: str) -> list[str]:
    """Partitioning argument of every Exchange node, e.g. 'hashpartitioning(business_key'."""
    return re.findall(r"\(\d+\) Exchange\s*\n(?:.*\n)*?Arguments: (\w+\(?\w*)", plan)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    Q.keyed_cash(spark, SF0001).write.parquet(f"{root}/cash")
    Q.keyed_rada(spark, SF0001).write.parquet(f"{root}/rada")
    Q.gold_history(spark, SF0001).write.partitionBy("_run_date").parquet(f"{root}/gold")
    return {k: spark.read.parquet(f"{root}/{k}") for k in ("cash", "rada", "gold")}


def test_matching_unique_keys_is_one_join(stored):
    """Keys without repeats: one full outer join, two exchanges, no window, no forced broadcast."""
    plan = _plan(match.classify(stored["cash"], stored["rada"]))
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan and "Window" not in plan
    assert plan.count("FullOuter") == 1 or len(re.findall(r"Join type: FullOuter", plan)) == 1
    assert len(_exchanges(plan)) == 2


def test_windows_of_repeated_keys_are_per_slice_or_bucket(spark):
    """Rows are numbered per slice of one amount; windows over a whole key see one row per bucket or slice."""
    from ledgermatch.functions.keys import prepare_for_matching
    from ledgermatch.sources import fixtures as fx

    cash, rada = fx.repeated_key_ledgers(spark, SF0001, skewed=True)
    plan = _plan(match.classify(prepare_for_matching(cash, "cash_id"), prepare_for_matching(rada, "rada_id")))
    assert "CartesianProduct" not in plan and "BroadcastExchange" not in plan
    ranks = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", plan)
    assert ranks and all("_slice" in r and "_at" in r for r in ranks)


def test_snapshot_reads_one_partition(stored):
    scan = _plan(snapshot_open_keys(stored["gold"], Q.RUN_DATE, 5))
    assert re.search(r"PartitionFilters: \[.*_run_date#\d+ = 2026-01-01", scan)
    assert "EqualTo(recon_status,UNMATCHED)" in scan
    assert "ReadSchema: struct<business_key:string,recon_status:string>" in scan


def test_kpis_read_one_partition_and_few_columns(stored):
    plan = _plan(kpis.kpi_daily(stored["gold"], Q.RUN_DATE))
    assert re.search(r"PartitionFilters: \[.*_run_date#\d+ = 2026-01-08", plan)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in read_schema.split(",")) == {
        "currency", "amount", "amount_variance", "recon_status"}


def test_dedup_combines_copies_before_the_shuffle(spark):
    from ledgermatch.config import CASH
    from ledgermatch.operators.standardise import standardise
    from ledgermatch.sources import fixtures as fx

    plan = _plan(standardise(fx.dirty_cash_bronze(spark, SF0001), CASH).clean)
    # a partial aggregate below the exchange on the id
    assert re.search(r"partial_max\(struct", plan)
    assert "hashpartitioning(cash_id" in _exchanges(plan)[0]
