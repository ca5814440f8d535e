import hashlib

from pyspark.sql import functions as F

from ledgermatch.functions.keys import key_text, prepare_for_matching


def _key(spark, **fields):
    base = {"account_number": "ACC1", "trade_reference": "TRD1", "settlement_date": "2026-05-05",
            "currency": "ZAR", "debit_credit": "D"}
    base.update(fields)
    df = spark.createDataFrame([base], ", ".join(f"{k} string" for k in base))
    df = df.withColumn("settlement_date", F.col("settlement_date").cast("date"))
    row = df.select(F.sha2(key_text(), 256).alias("k"), key_text().alias("t")).first()
    return row["k"], row["t"]


def test_key_is_sha256_of_pipe_joined_fields(spark):
    key, text = _key(spark)
    assert text == "ACC1|TRD1|2026-05-05|ZAR|D"
    assert key == hashlib.sha256(text.encode()).hexdigest()
    assert len(key) == 64 and all(c in "0123456789abcdef" for c in key)


def test_same_input_same_key(spark):
    assert _key(spark)[0] == _key(spark)[0]


def test_other_currency_or_case_gives_other_key(spark):
    k = _key(spark)[0]
    assert _key(spark, currency="USD")[0] != k
    assert _key(spark, account_number="acc1")[0] != k


def test_null_becomes_token_and_is_consistent(spark):
    k1, t1 = _key(spark, debit_credit=None)
    k2, _ = _key(spark, debit_credit=None)
    assert t1.endswith("|NULL") and k1 == k2
    # an empty string is a value, not NULL
    assert _key(spark, debit_credit="")[1].endswith("|")


def test_prepare_prunes_to_matching_columns(spark):
    from ledger_helpers import ledger_rows

    df = ledger_rows(spark, "cash_id", [("C1", "A", "T", "2026-01-01", "ZAR", 1.0, "D")])
    cols = prepare_for_matching(df, "cash_id").columns
    assert cols[:3] == ["business_key", "key_input", "cash_id"]
    assert sorted(cols[3:]) == ["account_number", "amount", "currency", "debit_credit", "narrative", "settlement_date",
                                "status", "swift_bic", "trade_reference", "value_date"]
