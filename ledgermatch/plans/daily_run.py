"""One reconciliation cycle, landing files to KPIs.

Every stage reads the previous stage's stored table and writes its own, so
a failed or repeated run picks up from stored state: ingest is exactly-once
through its checkpoint, silver is rebuilt from bronze, and every run-dated
output replaces only its own ``_run_date`` partition.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from ..config import CASH, RADA, Ledger, ReconConfig
from . import steps


@dataclass(frozen=True)
class Layout:
    """Where each table of the run lives, below one shared root folder."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, ledger: Ledger) -> str:
        return self._p("bronze", f"{ledger.name}_transactions")

    def silver(self, ledger: Ledger) -> str:
        return self._p("silver", f"{ledger.name}_transactions")

    def quarantine(self, ledger: Ledger) -> str:
        return self._p("silver", f"{ledger.name}_quarantine")

    def checkpoint(self, ledger: Ledger) -> str:
        return self._p("checkpoints", ledger.name)

    @property
    def dq_results(self) -> str:
        return self._p("silver", "dq_results")

    @property
    def gold(self) -> str:
        return self._p("gold", "reconciliation_results")

    @property
    def kpis(self) -> str:
        return self._p("gold", "reconciliation_kpis")

    @property
    def breakdown(self) -> str:
        return self._p("gold", "recon_currency_breakdown")

    @property
    def audit(self) -> str:
        return self._p("gold", "run_audit")

    def tables(self) -> list[tuple[str, str, str]]:
        """``(database, table, path)`` of every dataset the run writes."""
        out = []
        for ledger in (CASH, RADA):
            out += [("bronze", f"{ledger.name}_transactions", self.bronze(ledger)),
                    ("silver", f"{ledger.name}_transactions", self.silver(ledger)),
                    ("silver", f"{ledger.name}_quarantine", self.quarantine(ledger))]
        out += [("silver", "dq_results", self.dq_results), ("gold", "reconciliation_results", self.gold),
                ("gold", "reconciliation_kpis", self.kpis), ("gold", "recon_currency_breakdown", self.breakdown),
                ("gold", "run_audit", self.audit)]
        return out


def local_run_date(cfg: ReconConfig, now: dt.datetime | None = None) -> dt.date:
    """Today's date in the business time zone (a 01:00 job is already on the new day)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(ZoneInfo(cfg.time_zone)).date()


def run_daily(spark: SparkSession, layout: Layout, *, cash_landing: str, rada_landing: str,
              run_date: dt.date | str | None = None, run_ts: dt.datetime | str | None = None,
              cfg: ReconConfig = ReconConfig(), rada_sep: str = ",", rada_options: dict | None = None,
              fail_on_dq: bool = True) -> dict:
    """Run one cycle and return its KPI row and step counts as a dict.

    ``rada_options`` are passed to the RADA ingest (e.g. ``fixed_width``);
    ``rada_sep`` is the RADA delimiter for delimited extracts.
    """
    run_date = str(run_date or local_run_date(cfg))
    if run_ts is None:  # stamps are read in the session time zone
        session_tz = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
        run_ts = dt.datetime.now(session_tz).replace(tzinfo=None, microsecond=0)
    run_ts = str(run_ts)
    facts: dict[str, int] = {}

    def land_and_standardise(ledger: Ledger, landing: str, options: dict) -> dict[str, int]:
        # bronze: exactly-once file pickup, then the mandatory-column check
        res = steps.ingest_ledger(spark, ledger, landing, layout.bronze(ledger), layout.checkpoint(ledger), **options)
        missing = [c for c in ledger.required_cols if c not in spark.read.parquet(layout.bronze(ledger)).columns]
        if missing:
            raise ValueError(f"{layout.bronze(ledger)} lacks mandatory columns {missing}")
        out = steps.standardise_ledger(spark, ledger, layout.bronze(ledger), layout.silver(ledger),
                                       layout.quarantine(ledger), run_date, run_ts, cfg)
        return {f"{ledger.name}_ingested": res.new_rows, f"{ledger.name}_clean": out["clean_count"],
                f"{ledger.name}_quarantined": out["quarantine_count"]}

    # the ledgers are independent until matching: their jobs are submitted
    # from two threads and share the cluster
    with ThreadPoolExecutor(max_workers=2) as pool:
        futures = [pool.submit(land_and_standardise, CASH, cash_landing, {}),
                   pool.submit(land_and_standardise, RADA, rada_landing, {"sep": rada_sep, **(rada_options or {})})]
        for f in futures:
            facts.update(f.result())

    # data-quality gate on what was stored
    steps.run_dq_suite(spark, [(layout.silver(CASH), CASH), (layout.silver(RADA), RADA)], layout.dq_results,
                       run_date, run_ts, cfg, fail_on_error=fail_on_dq)

    # match with CLEARED against the stored history, upsert today's partition, KPIs
    steps.reconcile_to_gold(spark, layout.silver(CASH), layout.silver(RADA), layout.gold, run_date, run_ts, cfg)
    kpi_row = steps.compute_kpis(spark, layout.gold, layout.kpis, layout.breakdown, run_date)

    steps.record_run(spark, layout.audit, run_date, run_ts,
                     {**facts, "total_records": kpi_row["total_records"], "match_rate_pct": kpi_row["match_rate_pct"]})
    return {"run_date": run_date, "run_ts": run_ts, **facts, "kpi": kpi_row}
