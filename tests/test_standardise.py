import datetime as dt

from ledger_helpers import SF001
from pyspark.sql import functions as F

from ledgermatch.config import CASH
from ledgermatch.operators.standardise import standardise, standardise_counts
from ledgermatch.sources import fixtures as fx

COLS = ("cash_id string, account_number string, trade_reference string, swift_bic string, "
        "transaction_date string, value_date string, settlement_date string, currency string, amount string, "
        "debit_credit string, narrative string, status string, _ingested_ts timestamp")
TS = dt.datetime(2026, 1, 5, 1, 0)


def _row(cid="C1", acc="ACC1", trd="TRD1", settle="2026-05-05", cur="ZAR", amount="10.00", dc="D", ts=TS,
         narrative="n"):
    return (cid, acc, trd, "bic", settle, settle, settle, cur, amount, dc, narrative, "SETTLED", ts)


def _split(spark, rows):
    std = standardise(spark.createDataFrame(rows, COLS), CASH)
    return std.clean.collect(), std.quarantine.collect()


def test_trim_and_upper_case(spark):
    clean, _ = _split(spark, [_row(acc=" acc1 ", trd=" t1 ", cur=" zar", dc=" d ")])
    assert (clean[0]["account_number"], clean[0]["trade_reference"], clean[0]["currency"],
            clean[0]["debit_credit"]) == ("ACC1", "T1", "ZAR", "D")


def test_types(spark):
    clean, _ = _split(spark, [_row()])
    assert clean[0]["settlement_date"] == dt.date(2026, 5, 5) and clean[0]["amount"] == 10.0


def test_negative_amount_rejected(spark):
    clean, rejected = _split(spark, [_row(amount="-500")])
    assert not clean and rejected[0]["_rejection_reason"] == "mandatory_field_or_value_check_failed"


def test_debit_credit_only_d_or_c(spark):
    clean, rejected = _split(spark, [_row(cid="C1", dc="X"), _row(cid="C2", dc="C")])
    assert [r["cash_id"] for r in clean] == ["C2"] and [r["cash_id"] for r in rejected] == ["C1"]


def test_null_debit_credit_goes_to_quarantine(spark):
    """A row whose only fault is a NULL code lands in quarantine, not nowhere."""
    clean, rejected = _split(spark, [_row(dc=None)])
    assert not clean and len(rejected) == 1


def test_bad_date_and_number_quarantined_not_raised(spark):
    clean, rejected = _split(spark, [_row(cid="C1", settle="31/12/1998"), _row(cid="C2", amount="abc")])
    assert not clean and len(rejected) == 2
    by_id = {r["cash_id"]: r for r in rejected}
    assert by_id["C1"]["settlement_date"] is None and by_id["C2"]["amount"] is None


def test_nan_and_blank_rejected(spark):
    clean, rejected = _split(spark, [_row(cid="C1", amount="NaN"), _row(cid="C2", acc="   "),
                                     _row(cid="C3", acc=None)])
    assert not clean and len(rejected) == 3


def test_no_upper_bound_on_amounts(spark):
    clean, rejected = _split(spark, [_row(cid="C1", amount="1e20"), _row(cid="C2", amount="0.125"),
                                     _row(cid="C3", amount="9999999999999.99")])
    assert len(clean) == 3 and not rejected


def test_sums_keep_fractions_and_large_amounts(spark):
    from ledgermatch.functions.money import money_sum

    df = spark.createDataFrame([(0.004,), (0.004,), (0.002,), (1e16,)], "amount double")
    assert df.filter("amount < 1").agg(F.round(money_sum(F.col("amount")), 2)).first()[0] == 0.01
    assert df.agg(money_sum(F.col("amount"))).first()[0] == 1e16 + 0.01


def test_keys_of_any_length_stay_apart(spark):
    """Orders with 7 to 10 digit keys: none is cut, all survive de-duplication."""
    keys = [1, 1234567, 12345678, 123456789, 1234567890, 123456780, 10**9]
    orders = spark.createDataFrame([(k, k, 1.5, "2026-01-01", "1-URGENT") for k in keys],
                                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string, o_orderpriority string")
    bronze = fx._ledger(orders, "cash_id", "CSH", F.col("o_totalprice"), "SETTLED")
    clean = standardise(bronze, CASH).clean.collect()
    assert len({r["cash_id"] for r in clean}) == len({r["trade_reference"] for r in clean}) == len(keys)
    assert {len(r["trade_reference"]) for r in clean} == {3 + max(7, len(str(k))) for k in keys}


def test_fixed_width_refuses_values_that_do_not_fit(spark):
    import pytest
    from pyspark.errors import PySparkException

    from ledgermatch.sources import fixed_width

    df = spark.createDataFrame([("abc", "de")], "a string, b string")
    assert fixed_width.render(df, [("a", 4), ("b", 2)]).first()[0] == "abc de"
    with pytest.raises(PySparkException, match="does not fit"):
        fixed_width.render(df, [("a", 2), ("b", 2)]).collect()


def test_latest_copy_survives(spark):
    later = TS + dt.timedelta(hours=1)
    clean, _ = _split(spark, [_row(narrative="first"), _row(narrative="resent", ts=later)])
    assert len(clean) == 1 and clean[0]["narrative"] == "resent"


def test_every_row_accounted_for(spark):
    bronze = fx.dirty_cash_bronze(spark, SF001)
    std = standardise(bronze, CASH)
    n_in, n_ok, n_bad = bronze.count(), std.accepted.count(), std.quarantine.count()
    assert n_ok + n_bad == n_in
    counts = standardise_counts(bronze, CASH).first()
    assert (counts["input_rows"], counts["accepted_rows"], counts["quarantine_rows"]) == (n_in, n_ok, n_bad)
    assert counts["clean_rows"] == std.clean.count() == std.clean.select("cash_id").distinct().count()
    # faults 11,12,13,14,17,18,19 are rejected; 15 and 20 are repaired; 16 is a duplicate
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    per_fault = orders.filter(F.col("o_orderkey") % 50 == 11).count()
    assert n_bad == 7 * per_fault
