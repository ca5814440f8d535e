import pytest

from ledgermatch.config import CASH, ReconConfig
from ledgermatch.operators import quality

SCHEMA = ("cash_id string, account_number string, trade_reference string, settlement_date date, "
          "currency string, amount double")


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _good(i, amount=1.0):
    import datetime as dt
    return (f"C{i}", "A", "T", dt.date(2026, 1, 1), "ZAR", amount)


def test_completeness_threshold(spark):
    rows = [_good(i) for i in range(98)] + [(f"C{i}", None, "T", None, "ZAR", 1.0) for i in range(98, 100)]
    r = quality.check_completeness(_df(spark, rows), "t", CASH.required_cols).first()
    assert (r["status"], r["metric_value"]) == ("PASS", 0.98)
    assert r["detail"] == "98/100 rows complete"
    rows[0] = ("C0", None, "T", None, "ZAR", 1.0)
    assert quality.check_completeness(_df(spark, rows), "t", CASH.required_cols).first()["status"] == "FAIL"


def test_empty_table(spark):
    empty = _df(spark, [])
    assert quality.check_completeness(empty, "t", CASH.required_cols).first()["status"] == "FAIL"
    r = quality.check_duplicates(empty, "t", "cash_id").first()
    assert (r["status"], r["metric_value"]) == ("PASS", 0.0)


def test_duplicates_count_null_as_one_value(spark):
    rows = [_good(i) for i in range(1000)] + [_good(1), _good(2)]
    r = quality.check_duplicates(_df(spark, rows), "t", "cash_id").first()
    assert r["detail"] == "cash_id repeated in 2 of 1,002 rows" and r["status"] == "PASS"
    rows += [(None, "A", "T", None, "ZAR", 1.0)] * 6
    r = quality.check_duplicates(_df(spark, rows), "t", "cash_id").first()
    assert r["detail"].startswith("cash_id repeated in 7 ") and r["status"] == "FAIL"


def test_negative_amounts(spark):
    r = quality.check_negative_amounts(_df(spark, [_good(1), _good(2, -5.0)]), "t").first()
    assert (r["status"], r["metric_value"], r["threshold"]) == ("FAIL", 0.5, 0.0)


def test_schema_names_and_types(spark):
    df = _df(spark, [_good(1)])
    assert quality.check_schema(df, "t", ["cash_id", "x", "y"]).first()["metric_value"] == 2.0
    r = quality.check_schema(df, "t", {"amount": "double", "settlement_date": "string"}).first()
    assert r["status"] == "FAIL" and "settlement_date" in r["detail"]


def test_suite_reports_missing_columns_instead_of_raising(spark):
    df = _df(spark, [_good(1)]).drop("amount")
    rows = quality.table_checks(df, "t", CASH, ReconConfig()).collect()
    assert len(rows) == 4 and all(r["status"] == "FAIL" for r in rows)


def test_gate_raises(spark):
    bad = quality.run_suite([(_df(spark, [_good(1, -1.0)]), "t", CASH)])
    with pytest.raises(quality.DataQualityError):
        quality.gate(bad)
    assert len(quality.gate(bad, fail_on_error=False)) == 4
