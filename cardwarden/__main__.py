"""Command line: the whole run, or one of its steps.

    spark-submit --py-files cardwarden.zip cardwarden/__main__.py run \\
        --transactions /lake/incoming/2026-03-31/ --out /lake/cards

Exits with 1 if a quality gate fails. Master and storage settings come from the
cluster's Spark configuration.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from cardwarden.operators.fraud import PRESETS
from cardwarden.operators.quality import QualityGateError
from cardwarden.plans import medallion

STEPS = ("run", "bronze", "silver", "fraud", "kpi", "devices")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cardwarden", description="Run a step of the pipeline.")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--out", required=True, help="root of the lake")
    parser.add_argument("--transactions", help="CSV files (run, bronze)")
    parser.add_argument("--profiles", help="JSON files (run, devices)")
    parser.add_argument(
        "--profile-lines", action="store_true", help="profiles are JSON lines, not arrays"
    )
    parser.add_argument("--preset", choices=sorted(PRESETS), default="strict")
    parser.add_argument(
        "--hold-bad-rows", action="store_true", help="quarantine bad rows and go on (run)"
    )
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="the run's time")
    args = parser.parse_args(argv)
    if args.step in ("run", "bronze") and not args.transactions:
        parser.error(f"{args.step} needs --transactions")
    if args.step == "devices" and not args.profiles:
        parser.error("devices needs --profiles")
    return args


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = (
        SparkSession.builder.appName(f"cardwarden {args.step}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    layout = medallion.Layout(args.out)
    try:
        if args.step == "run":
            summary = medallion.run(
                spark,
                args.transactions,
                args.out,
                args.profiles,
                preset=args.preset,
                as_of=args.as_of,
                hold_bad_rows=args.hold_bad_rows,
                profile_lines=args.profile_lines,
            )
            print(f"{summary.alert_count} alerts")
        elif args.step == "bronze":
            medallion.land_and_gate(spark, args.transactions, layout, as_of=args.as_of)
        elif args.step == "silver":
            medallion.build_silver(spark, layout, as_of=args.as_of)
        elif args.step == "fraud":
            print(f"{medallion.build_fraud(spark, layout, args.preset)} alerts")
        elif args.step == "kpi":
            medallion.build_kpis(spark, layout, args.as_of)
        else:
            medallion.build_device_alerts(
                spark, layout, args.profiles, as_of=args.as_of, profile_lines=args.profile_lines
            )
    except QualityGateError as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
