import os

import pytest
from ledger_helpers import SF0001
from pyspark.errors import StreamingQueryException

from ledgermatch.config import CASH, RADA
from ledgermatch.sinks import tables
from ledgermatch.sources import fixtures as fx
from ledgermatch.streaming.ingest import ingest, validate_schema


def _land(spark, df, path, sep=","):
    df.drop("_ingested_ts").coalesce(2).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def test_exactly_once_and_new_files(spark, workdir):
    cash = fx.cash_bronze(spark, SF0001)
    n = cash.count()
    _land(spark, cash.filter("cash_id < 'CSH00003000'"), f"{workdir}/landing/day1")
    first = ingest(spark, f"{workdir}/landing/*", f"{workdir}/bronze", f"{workdir}/ckpt", CASH)
    again = ingest(spark, f"{workdir}/landing/*", f"{workdir}/bronze", f"{workdir}/ckpt", CASH)
    assert again.new_rows == 0 and again.total_rows == first.total_rows == first.new_rows
    _land(spark, cash.filter("cash_id >= 'CSH00003000'"), f"{workdir}/landing/day2")
    third = ingest(spark, f"{workdir}/landing/*", f"{workdir}/bronze", f"{workdir}/ckpt", CASH)
    assert third.total_rows == n and third.new_rows == n - first.total_rows
    bronze = spark.read.parquet(f"{workdir}/bronze")
    assert {"_ingested_ts", "_source_file", "_batch_date"} <= set(bronze.columns)
    assert bronze.filter("_source_file IS NULL").count() == 0


def test_bounded_micro_batches_count_every_row(spark, workdir):
    cash = fx.cash_bronze(spark, SF0001)
    cash.drop("_ingested_ts").repartition(6).write.option("header", True).csv(f"{workdir}/landing")
    res = ingest(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ckpt", CASH, max_files_per_trigger=1)
    assert res.new_rows == res.total_rows == cash.count()


def test_reordered_header_fails_instead_of_shifting(spark, workdir):
    cash = fx.cash_bronze(spark, SF0001).drop("_ingested_ts")
    cols = cash.columns
    _land(spark, cash.select(cols[1], cols[0], *cols[2:]), f"{workdir}/landing")
    with pytest.raises((StreamingQueryException, Exception)):
        ingest(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ckpt", CASH)


def test_pipe_delimited_extract(spark, workdir):
    rada = fx.rada_bronze(spark, SF0001)
    _land(spark, rada, f"{workdir}/landing", sep="|")
    res = ingest(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ckpt", RADA, sep="|")
    assert res.new_rows == rada.count()
    back = spark.read.parquet(f"{workdir}/bronze").select(*rada.drop("_ingested_ts").columns)
    assert back.exceptAll(rada.drop("_ingested_ts")).count() == 0


def test_validate_schema(spark):
    r = validate_schema(fx.cash_bronze(spark, SF0001), "b", CASH).first()
    assert r["schema_valid"] and r["missing_mandatory_columns"] == ""
    r = validate_schema(fx.cash_bronze(spark, SF0001).drop("amount"), "b", CASH).first()
    assert not r["schema_valid"] and r["missing_mandatory_columns"] == "amount"


def test_csv_export_round_trip(spark, workdir):
    df = fx.cash_bronze(spark, SF0001).drop("_ingested_ts")
    tables.write_csv(df, f"{workdir}/out")
    assert any(f.endswith(".csv") for f in os.listdir(f"{workdir}/out"))
    assert tables.read_csv(spark, f"{workdir}/out", df.schema).exceptAll(df).count() == 0
