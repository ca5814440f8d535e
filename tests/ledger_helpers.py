"""Shared helpers of the ledger tests."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def ledger_rows(spark, id_col, rows):
    """Small typed silver ledger from tuples
    (id, account, trade_ref, settlement_date, currency, amount, debit_credit)."""
    from pyspark.sql import functions as F

    schema = (f"{id_col} string, account_number string, trade_reference string, settlement_date string, "
              "currency string, amount double, debit_credit string")
    df = spark.createDataFrame(rows, schema)
    return df.select(
        id_col, "account_number", "trade_reference", F.lit("SWFT").alias("swift_bic"),
        F.col("settlement_date").cast("date").alias("transaction_date"),
        F.col("settlement_date").cast("date").alias("value_date"),
        F.col("settlement_date").cast("date").alias("settlement_date"),
        "currency", "amount", "debit_credit", F.lit("n").alias("narrative"), F.lit("S").alias("status"))
