"""Command line: spark-submit or ``python -m tributary <step> --root <folder> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession, functions as F

from tributary.functions.calendar import current_cycle
from tributary.operators.quality import QualityError, freshness
from tributary.options import Options, Thresholds
from tributary.plans import ingest, run
from tributary.plans.stored import raw_facts
from tributary.session import build_session
from tributary.sources.landing import read_lines
from tributary.sources.layers import GRAINS, Layers


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tributary")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--grain", choices=list(GRAINS), default="day")
    steps = parser.add_subparsers(dest="step", required=True)

    def facts_options(step: argparse.ArgumentParser) -> None:
        step.add_argument("--max-records", type=int, help="load only so many of the newest")
        step.add_argument("--memo-length", type=int, help="keep only so much of memo texts")
        step.add_argument("--state")
        step.add_argument("--cycle", type=int)
        step.add_argument("--min-amount", type=float)
        step.add_argument("--min-date", type=dt.date.fromisoformat)
        step.add_argument("--max-date", type=dt.date.fromisoformat)
        step.add_argument("--since-watermark", action="store_true")
        step.add_argument("--lookback-days", type=int, default=7)

    step = steps.add_parser("contributions", help="load facts")
    facts_options(step)
    source = step.add_mutually_exclusive_group(required=True)
    source.add_argument("--records", help="source records, JSON lines")
    source.add_argument("--input-file", help="normalised records, loaded as they are")
    step.add_argument("--save-sample")
    step.add_argument("--quarantine", help="folder for records that cannot be read")
    step.add_argument("--dry-run", action="store_true")

    step = steps.add_parser("committees", help="load the dimension")
    source = step.add_mutually_exclusive_group(required=True)
    source.add_argument("--records", help="source records, JSON lines")
    source.add_argument("--input-file", help="normalised records, loaded as they are")
    step.add_argument("--from-contributions", action="store_true")
    step.add_argument("--cycle", type=int)
    step.add_argument("--max-records", type=int, help="with a cycle: only so many, by identifier")
    step.add_argument("--save-sample")
    step.add_argument("--quarantine", help="folder for records that cannot be read")
    step.add_argument("--dry-run", action="store_true")

    step = steps.add_parser("marts", help="build both marts and check them")
    step.add_argument("--full-refresh", action="store_true")
    step.add_argument("--repair-moved-keys", action="store_true")
    step = steps.add_parser("export", help="write the dashboard snapshots")
    step.add_argument("--publish-to")
    step = steps.add_parser("freshness", help="fail when the raw facts are old")
    step.add_argument("--hours", type=int, default=24)

    step = steps.add_parser("batch", help="all steps in order")
    facts_options(step)
    step.add_argument("--records", required=True)
    step.add_argument("--committee-records", required=True)
    step.add_argument("--full-refresh", action="store_true")
    return parser


def request_of(args: argparse.Namespace) -> ingest.FactRequest:
    cycle = args.cycle if args.cycle is not None else current_cycle()
    return ingest.FactRequest(
        cycle=cycle, since_watermark=args.since_watermark, min_date=args.min_date,
        max_date=args.max_date, lookback_days=args.lookback_days, state=args.state,
        min_amount=args.min_amount, max_records=args.max_records,
        memo_length=args.memo_length)


def perform(spark: SparkSession, args: argparse.Namespace, options: Options = Options(),
            thresholds: Thresholds = Thresholds(), now: dt.datetime | None = None) -> int:
    layers = Layers(args.root, grain=args.grain)
    now = now or dt.datetime.now(dt.UTC)
    if args.step == "contributions":
        lines = read_lines(spark, args.records) if args.records else None
        load = ingest.ingest_facts(
            spark, layers, request_of(args), run_at=now, lines=lines, input_file=args.input_file,
            options=options, thresholds=thresholds, sample_path=args.save_sample,
            quarantine_path=args.quarantine, dry_run=args.dry_run)
        print(load)
    elif args.step == "committees":
        if args.input_file:
            print(ingest.ingest_committee_file(spark, layers, args.input_file, args.dry_run,
                                               args.save_sample))
        elif args.from_contributions:
            print(ingest.ingest_committees(
                spark, layers, read_lines(spark, args.records), now=now,
                max_age_days=thresholds.dimension_max_age_days, dry_run=args.dry_run,
                sample_path=args.save_sample, quarantine_path=args.quarantine))
        else:
            cycle = args.cycle if args.cycle is not None else current_cycle()
            print(ingest.ingest_committees_of_cycle(
                layers, read_lines(spark, args.records), cycle, loaded_at=F.lit(now),
                max_records=args.max_records, dry_run=args.dry_run,
                sample_path=args.save_sample, quarantine_path=args.quarantine))
    elif args.step == "marts":
        print(run.build_and_check(spark, layers, options, thresholds, args.full_refresh,
                                  args.repair_moved_keys))
    elif args.step == "export":
        print(run.export_marts(spark, layers, options, exported_at=now,
                               publish_to=args.publish_to))
    elif args.step == "freshness":
        raw = raw_facts(spark, layers)
        row = None if raw is None else freshness(raw, "_loaded_at", now, args.hours).first()
        print(row)
        return 1 if row is None or row["is_stale"] else 0
    else:
        print(run.run_batch(spark, layers, read_lines(spark, args.records),
                            read_lines(spark, args.committee_records), request_of(args),
                            run_at=now, options=options, thresholds=thresholds,
                            full_refresh=args.full_refresh))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    spark = build_session()
    try:
        return perform(spark, args)
    except (QualityError, ingest.EmptyLoadError, FileNotFoundError, ValueError) as error:
        print(f"ERROR: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
