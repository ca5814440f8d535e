"""Ingest of extracts whose columns change."""

import os
import shutil

import pytest
from ledger_helpers import SF0001
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from ledgermatch.config import CASH, RESCUED
from ledgermatch.operators.standardise import standardise
from ledgermatch.plans import queries
from ledgermatch.schemas import landing_schema
from ledgermatch.sources import fixtures as fx
from ledgermatch.streaming.evolving import ingest_evolving, merged_columns, read_bronze, stored_columns

NAMES = [f.name for f in landing_schema(CASH).fields]
ROW = {"cash_id": "C1", "account_number": "A", "trade_reference": "T", "swift_bic": "S", "transaction_date": "2026-01-01",
       "value_date": "2026-01-01", "settlement_date": "2026-01-02", "currency": "ZAR", "amount": "5.0", "debit_credit": "D",
       "narrative": "n", "status": "SETTLED"}


def land(workdir, name, names, *lines, end="\n"):
    os.makedirs(f"{workdir}/landing", exist_ok=True)
    with open(f"{workdir}/landing/{name}.csv", "w") as f:
        f.write(end.join([",".join(names), *lines]) + end if names else "")


def line(names, **other):
    return ",".join({**ROW, "note": "x", **other}[n] for n in names)


def load(spark, workdir, checkpoint="ckpt", **options):
    ingest_evolving(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/{checkpoint}", f"{workdir}/schema", CASH, **options)
    return read_bronze(spark, f"{workdir}/bronze", f"{workdir}/schema")


def test_columns_are_added_and_reordered(spark, workdir):
    land(workdir, "a", NAMES, line(NAMES))
    assert "note" not in load(spark, workdir).columns
    land(workdir, "b", [*NAMES, "note"], line([*NAMES, "note"], cash_id="C2"))
    land(workdir, "c", ["note", *reversed(NAMES)], line(["note", *reversed(NAMES)], cash_id="C3", note="y"), end="\r\n")
    land(workdir, "d", [n for n in NAMES if n != "narrative"], line([n for n in NAMES if n != "narrative"], cash_id="C4"))
    land(workdir, "e", [])
    got = {r["cash_id"]: r for r in load(spark, workdir).collect()}
    assert {k: r["note"] for k, r in got.items()} == {"C1": None, "C2": "x", "C3": "y", "C4": None}
    assert {r["narrative"] for k, r in got.items() if k != "C4"} == {"n"} and got["C4"]["narrative"] is None
    assert {r["amount"] for r in got.values()} == {5.0} and {r[RESCUED] for r in got.values()} == {None}
    assert [n for n, _ in stored_columns(spark, f"{workdir}/schema")] == [*NAMES, "note"]


def test_nothing_new_and_a_repeated_batch_change_nothing(spark, workdir):
    land(workdir, "a", NAMES, line(NAMES), line(NAMES, cash_id="C2"))
    assert load(spark, workdir).count() == 2
    assert load(spark, workdir).count() == 2
    # as after a failure between the write and the commit: the batch is planned, not committed
    shutil.copytree(f"{workdir}/ckpt", f"{workdir}/again", ignore=shutil.ignore_patterns("commits"))
    assert load(spark, workdir, checkpoint="again").count() == 2


def test_lines_that_do_not_fit_are_rescued(spark, workdir):
    bad = [line(NAMES, cash_id="C2", amount="abc"), line(NAMES, cash_id="C3") + ",more", "C4,A", 'C5,"A']
    land(workdir, "a", NAMES, line(NAMES), *bad[:2], "", *bad[2:])
    bronze = load(spark, workdir)
    assert sorted(r[RESCUED] for r in bronze.collect() if r[RESCUED]) == sorted(bad) and bronze.count() == 5
    split = standardise(bronze, CASH)
    assert [r["cash_id"] for r in split.clean.collect()] == ["C1"] and RESCUED not in split.clean.columns
    assert sorted(r[RESCUED] for r in split.quarantine.collect()) == sorted(bad)


@pytest.mark.parametrize("names", [[n for n in NAMES if n != "amount"], [*NAMES, "status"], ["other"]])
def test_files_that_cannot_be_loaded_are_refused(spark, workdir, names):
    land(workdir, "a", names, line([n for n in names if n in ROW]))
    with pytest.raises(StreamingQueryException):
        load(spark, workdir)
    assert not os.path.exists(f"{workdir}/bronze")


def test_a_changed_type_is_refused(spark, workdir):
    land(workdir, "a", NAMES, line(NAMES))
    load(spark, workdir)
    with pytest.raises(ValueError, match="amount"):
        load(spark, workdir, declared=T.StructType([T.StructField("amount", T.StringType())]))
    assert merged_columns([("a", "string")], [("b", "double")], ["c", "a", "c"]) == [
        ("a", "string"), ("b", "double"), ("c", "string")]


def test_every_landed_line_is_in_bronze(spark):
    days = fx.evolving_cash_days(spark, SF0001)
    assert queries.q_ingest_evolving(spark, SF0001).count() == sum(d.count() for d in days)
