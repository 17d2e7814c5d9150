"""Command line: ``python -m pagetrail run SOURCE ROOT`` and ``report ROOT`` for whole logs;
``deliver SOURCE ROOT LOG`` and ``advance ROOT DAY`` for one that grows by days."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from pagetrail.plans.increments import increments, ingest_days, read_gold, run_increment
from pagetrail.plans.layered_run import read_bronze, run_layers, show_reports
from pagetrail.schema import GAP_SECONDS
from pagetrail.sources.layers import preview, read_layer
from pagetrail.sources.quarantine import reason_counts, still_rejected
from pagetrail.sources.runs import layer_path


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pagetrail", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="build all layers, exports and reports from JSON lines")
    run.add_argument("source")
    run.add_argument("root")
    run.add_argument("--run-id", type=int, help="a new number; default: the next free one")
    run.add_argument("--gap-seconds", type=int, default=GAP_SECONDS)
    run.add_argument("--stages", nargs="*", help="Gold stage columns; default: every page found")
    run.add_argument("--keep-null-times", action="store_true")
    run.add_argument("--no-event-export", action="store_true", help="no CSV of bronze and silver")
    report = commands.add_parser("report", help="print the funnel and durations of a run")
    report.add_argument("root")
    report.add_argument("--run-id", type=int, help="as of this run; default: the last one")
    deliver = commands.add_parser("deliver", help="sort JSON lines into days and the quarantine")
    deliver.add_argument("source")
    deliver.add_argument("root")
    deliver.add_argument("log", help="name of the delivery; one of the same name is replaced")
    advance = commands.add_parser("advance", help="add the days up to DAY to the layers")
    advance.add_argument("root")
    advance.add_argument("day", type=dt.date.fromisoformat)
    advance.add_argument("--gap-seconds", type=int, default=GAP_SECONDS)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("pagetrail").getOrCreate()
    if args.command == "report":
        return 0 if show_reports(spark, args.root, args.run_id) else 1
    if args.command == "deliver":
        ingest_days(spark, args.source, args.root, args.log)
        reason_counts(still_rejected(spark, args.root)).show(truncate=False)
        return 0
    if args.command == "advance":
        done = run_increment(spark, args.root, args.day, args.gap_seconds)
        if done.carry_changed:
            for upto in [d for d in increments(spark, args.root) if d > args.day]:
                print(f"repeat the run up to {upto}")
        preview(read_gold(spark, args.root)).show()
        return 0
    counts = run_layers(
        spark,
        args.source,
        args.root,
        run_id=args.run_id,
        gap_seconds=args.gap_seconds,
        stages=args.stages,
        keep_null_times=args.keep_null_times,
        export_events=not args.no_event_export,
    )
    print(f"{counts.events} events read, {counts.rejected} rejected")
    preview(read_bronze(spark, args.root, counts.run_id)).show()
    for layer in ("silver", "gold"):
        preview(read_layer(spark, layer_path(args.root, counts.run_id, layer))).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
