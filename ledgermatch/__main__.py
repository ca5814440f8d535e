"""Command line: run one reconciliation cycle (the entry point for spark-submit).

    spark-submit --py-files ledgermatch.zip -m ledgermatch run \\
        --root /shared/recon --cash-landing /shared/landing/cash/* \\
        --rada-landing /shared/landing/rada/* [--run-date 2026-01-08] [--register]

Options mirror ``ReconConfig``; ``--rada-format fixed`` reads fixed-width
RADA extracts (amounts scaled by ``--rada-amount-scale``).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from .config import RADA, ReconConfig
from .plans import steps
from .plans.daily_run import Layout, run_daily
from .session import build_session
from .sinks import catalog
from .sources.fixed_width import ledger_layout


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgermatch")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="ingest, standardise, check, match, upsert gold, KPIs")
    run.add_argument("--root", required=True, help="shared folder holding every table of the cycle")
    run.add_argument("--cash-landing", required=True)
    run.add_argument("--rada-landing", required=True)
    run.add_argument("--checkpoint-dir", help="folder shared by driver and executors; default: spark.checkpoint.dir")
    run.add_argument("--run-date", help="yyyy-MM-dd; default: today in the configured time zone")
    run.add_argument("--run-ts", help="yyyy-MM-dd HH:mm:ss; default: now in the session time zone")
    run.add_argument("--rada-format", choices=("delimited", "fixed"), default="delimited")
    run.add_argument("--rada-sep", default=",")
    run.add_argument("--no-fail-on-dq", action="store_true", help="record failed checks but continue")
    run.add_argument("--register", action="store_true", help="register the tables in the catalog")
    run.add_argument("--optimize", action="store_true",
                     help="afterwards rewrite today's gold partition range-clustered on the filter columns")
    for f in fields(ReconConfig):
        if f.type in ("float", "int", "bool", "str"):
            run.add_argument(f"--{f.name.replace('_', '-')}", type=str, default=None)
    return p


def _config(args: argparse.Namespace) -> ReconConfig:
    values = {}
    for f in fields(ReconConfig):
        raw = getattr(args, f.name, None)
        if raw is None:
            continue
        values[f.name] = {"float": float, "int": int, "str": str,
                          "bool": lambda v: v.lower() in ("1", "true", "yes")}[f.type](raw)
    return ReconConfig(**values)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    cfg = _config(args)
    spark = build_session()
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    layout = Layout(args.root)
    rada_options = {"fixed_width": ledger_layout(RADA)} if args.rada_format == "fixed" else None
    summary = run_daily(spark, layout, cash_landing=args.cash_landing, rada_landing=args.rada_landing,
                        run_date=args.run_date, run_ts=args.run_ts, cfg=cfg, rada_sep=args.rada_sep,
                        rada_options=rada_options, fail_on_dq=not args.no_fail_on_dq)
    if args.optimize:
        steps.optimize_gold(spark, layout.gold, summary["run_date"], cfg)
    if args.register:
        summary["registered"] = catalog.register(spark, layout.tables())
    print(json.dumps(summary, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
