"""Two cycles end to end, from landing CSV files to KPIs, plus a re-run."""

from ledger_helpers import SF0001
from pyspark.sql import functions as F

from ledgermatch.plans import queries as Q
from ledgermatch.plans.daily_run import Layout, run_daily
from ledgermatch.sources import fixtures as fx


def _land(df, path, sep=","):
    df.drop("_ingested_ts").coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def test_two_cycles_and_rerun(spark, workdir):
    layout = Layout(f"{workdir}/lake")
    cash_landing, rada_landing = f"{workdir}/landing/cash", f"{workdir}/landing/rada"
    cash = fx.cash_bronze(spark, SF0001)
    rada_early = fx.rada_bronze(spark, SF0001, earlier=True)
    rada_all = fx.rada_bronze(spark, SF0001)

    _land(cash, f"{cash_landing}/d1")
    _land(rada_early, f"{rada_landing}/d1", sep="|")
    day1 = run_daily(spark, layout, cash_landing=f"{cash_landing}/*", rada_landing=f"{rada_landing}/*",
                     run_date=Q.PREV_RUN_DATE, run_ts=Q.PREV_RUN_TS, rada_sep="|")
    assert day1["cash_ingested"] == cash.count() and day1["kpi"]["cleared"] == 0
    assert day1["cash_clean"] == cash.count() and day1["cash_quarantined"] == 0
    assert day1["rada_clean"] == rada_early.count()

    # the late RADA records arrive; a week later they clear the old breaks
    _land(rada_all.join(rada_early, "rada_id", "left_anti"), f"{rada_landing}/d8", sep="|")
    day8 = run_daily(spark, layout, cash_landing=f"{cash_landing}/*", rada_landing=f"{rada_landing}/*",
                     run_date=Q.RUN_DATE, run_ts=Q.RUN_TS, rada_sep="|")
    assert day8["cash_ingested"] == 0 and day8["rada_ingested"] == rada_all.count() - rada_early.count()

    expected = Q.q_kpi_daily(spark, SF0001).first().asDict()
    got = dict(day8["kpi"])
    assert str(got.pop("run_date")) == str(expected.pop("run_date"))
    assert got == expected and got["cleared"] > 0

    gold = spark.read.parquet(layout.gold)
    n_gold = gold.count()
    # re-running the same day changes nothing
    again = run_daily(spark, layout, cash_landing=f"{cash_landing}/*", rada_landing=f"{rada_landing}/*",
                      run_date=Q.RUN_DATE, run_ts=Q.RUN_TS, rada_sep="|")
    assert again["kpi"] == day8["kpi"]
    assert spark.read.parquet(layout.gold).count() == n_gold
    assert spark.read.parquet(layout.kpis).count() == 2
    assert spark.read.parquet(layout.audit).count() == 2
    dq = spark.read.parquet(layout.dq_results)
    assert dq.filter(F.col("status") == "FAIL").count() == 0 and dq.count() == 16


def test_register_tables_in_catalog(spark, workdir):
    from ledgermatch.sinks import catalog, tables

    layout = Layout(f"{workdir}/lake")
    gold = Q.gold_history(spark, SF0001)
    tables.overwrite_partitions(gold, layout.gold)
    names = catalog.register(spark, layout.tables(), prefix="t_")
    assert names == ["t_gold.reconciliation_results"]
    assert spark.table("t_gold.reconciliation_results").count() == gold.count()
    assert spark.sql("SELECT count(*) FROM t_gold.reconciliation_results "
                     f"WHERE _run_date = DATE '{Q.RUN_DATE}'").first()[0] == Q.current_gold(spark, SF0001).count()


def test_step_api_per_class_frames(spark, workdir):
    """The four class frames plus CLEARED merged into gold give the same KPIs
    as the single-pass path."""
    from ledgermatch.config import CASH
    from ledgermatch.operators import match
    from ledgermatch.operators.cleared import detect_cleared
    from ledgermatch.plans import steps

    layout = Layout(f"{workdir}/lake")
    prev = Q.previous_gold(spark, SF0001)
    steps.merge_to_gold(spark, [prev.drop("_run_ts", "_run_date")], layout.gold, Q.PREV_RUN_DATE, Q.PREV_RUN_TS)
    m, u, n, mm = match.reconcile(Q.keyed_cash(spark, SF0001), Q.keyed_rada(spark, SF0001))
    cleared, still = detect_cleared(Q.classified(spark, SF0001), spark.read.parquet(layout.gold), Q.RUN_DATE)
    steps.merge_to_gold(spark, [m, still.select(*u.columns), n, cleared, mm], layout.gold, Q.RUN_DATE, Q.RUN_TS)
    got = steps.compute_kpis(spark, layout.gold, layout.kpis, layout.breakdown, Q.RUN_DATE)
    expected = Q.q_kpi_daily(spark, SF0001).first().asDict()
    assert {k: v for k, v in got.items() if k != "run_date"} == {k: v for k, v in expected.items() if k != "run_date"}

    landing = f"{workdir}/landing"
    _land(Q.fx.cash_bronze(spark, SF0001), landing)
    steps.ingest_ledger(spark, CASH, landing, f"{workdir}/bronze", f"{workdir}/ckpt")
    v = steps.validate_bronze(spark, CASH, f"{workdir}/bronze")
    assert v["schema_valid"] and v["row_count"] == Q.fx.cash_bronze(spark, SF0001).count()


def test_command_line_with_fixed_width_minor_units(spark, workdir, capsys):
    """`python -m ledgermatch run` on a fixed-width RADA extract in cents gives
    the same status counts as the delimited, decimal extract."""
    import json

    from ledgermatch.__main__ import main
    from ledgermatch.config import RADA
    from ledgermatch.functions.keys import prepare_for_matching
    from ledgermatch.operators.match import classify
    from ledgermatch.sources import fixed_width

    _land(Q.fx.cash_bronze(spark, SF0001), f"{workdir}/landing/cash")
    lines = fixed_width.render(Q.fx.rada_minor_units(spark, SF0001), fixed_width.ledger_layout(RADA))
    lines.coalesce(1).write.text(f"{workdir}/landing/rada")
    assert main(["run", "--root", f"{workdir}/lake", "--cash-landing", f"{workdir}/landing/cash",
                 "--rada-landing", f"{workdir}/landing/rada", "--rada-format", "fixed",
                 "--rada-amount-scale", "100", "--run-date", Q.RUN_DATE, "--run-ts", Q.RUN_TS]) == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    counts = {r["recon_status"]: r["count"] for r in
              classify(Q.keyed_cash(spark, SF0001), prepare_for_matching(Q.whole_rada(spark, SF0001), "rada_id"))
              .groupBy("recon_status").count().collect()}
    kpi = summary["kpi"]
    assert (kpi["matched"], kpi["unmatched"], kpi["new"], kpi["amount_mismatch"], kpi["cleared"]) == \
        (counts["MATCHED"], counts.get("UNMATCHED", 0), counts["NEW"], counts["AMOUNT_MISMATCH"], 0)


def test_run_date_is_taken_in_the_business_time_zone():
    """A 01:00 job in Johannesburg (UTC+2) runs while UTC is still on the day before."""
    import datetime as dt

    from ledgermatch.config import ReconConfig
    from ledgermatch.plans.daily_run import local_run_date

    at = dt.datetime(2026, 1, 7, 23, 0, tzinfo=dt.timezone.utc)   # 01:00 on the 8th in Johannesburg
    assert local_run_date(ReconConfig(), at) == dt.date(2026, 1, 8)
    assert local_run_date(ReconConfig(time_zone="UTC"), at) == dt.date(2026, 1, 7)
