"""Command line: ``python -m cardwatch --warehouse W --landing L [--seeds S]``.

Bootstraps the warehouse from seed files when it does not exist yet, then
processes every pending business date in the landing folder, earliest first
(``--max-days 1`` processes only the earliest, like one scheduled run).
The cluster master comes from ``spark-defaults.conf`` or ``--master``.
"""

from __future__ import annotations

import argparse
import json

from .config import build_session
from .plans import daily
from .schemas import SEED_ACCOUNTS, SEED_CARDS, SEED_CLIENTS
from .sources import read_seed


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cardwatch")
    p.add_argument("--warehouse", required=True, help="warehouse root (any Hadoop path)")
    p.add_argument("--landing", required=True, help="landing folder with the daily files")
    p.add_argument("--seeds", help="folder with cards, accounts, clients seed files")
    p.add_argument("--seed-format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--max-days", type=int, default=None)
    p.add_argument("--grace-days", type=int, default=daily.RuleParams.grace_days)
    p.add_argument("--max-gap-seconds", type=int, default=daily.RuleParams.max_gap_seconds)
    p.add_argument("--max-span-seconds", type=int, default=daily.RuleParams.max_span_seconds)
    p.add_argument("--lookback-days", type=int, default=0,
                   help="earlier days as look-back context (0 = latest day only)")
    p.add_argument("--master", default=None, help="only for local runs")
    args = p.parse_args(argv)

    spark = build_session(args.master)
    wh = daily.Warehouse(args.warehouse)
    if args.seeds:
        ext = "parquet" if args.seed_format == "parquet" else "csv"
        seeds = [read_seed(spark, f"{args.seeds.rstrip('/')}/{name}.{ext}", schema,
                           args.seed_format)
                 for name, schema in (("cards", SEED_CARDS), ("accounts", SEED_ACCOUNTS),
                                      ("clients", SEED_CLIENTS))]
        daily.bootstrap(spark, wh, *seeds)
    params = daily.RuleParams(grace_days=args.grace_days, max_gap_seconds=args.max_gap_seconds,
                              max_span_seconds=args.max_span_seconds,
                              lookback_days=args.lookback_days)
    done = daily.backfill(spark, wh, args.landing, params, max_days=args.max_days)
    print(json.dumps([{**r, "date": str(r["date"])} for r in done]))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
