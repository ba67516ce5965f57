"""Jobs from the command line: ``spark-submit``-able, or ``python -m shoptrail <job> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail import schemas as S
from shoptrail.operators.sampling import first_rows, fixed_size_sample, stamp_event_ids
from shoptrail.plans import medallion
from shoptrail.plans.medallion import Lake
from shoptrail.quality import suites
from shoptrail.session import shared_dir, start
from shoptrail.sources import csv_events, publish, topic


def _positive(text: str) -> int:
    number = int(text)
    if number <= 0:
        raise argparse.ArgumentTypeError("must be positive")
    return number


def _day(text: str) -> str:
    return dt.date.fromisoformat(text).isoformat()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shoptrail")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *, lake: bool = True) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=about)
        if lake:
            added.add_argument("--lake", required=True, help="root folder of all layers")
        return added

    def topic_options(added: argparse.ArgumentParser) -> None:
        added.add_argument("--servers", help="Kafka bootstrap servers")
        added.add_argument("--topic", default="shop_events")
        added.add_argument("--files", help="folder of envelope files, in place of a broker")

    def mode_option(added: argparse.ArgumentParser) -> None:
        added.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")

    sample = job("sample", "draw a fixed-size sample from source CSV files", lake=False)
    sample.add_argument("--input", help=f"a CSV file; without it the source in {csv_events.SOURCE_FOLDER}")
    sample.add_argument("--source-folder", default=csv_events.SOURCE_FOLDER, help="where the source lies without --input")
    sample.add_argument("--folder", action="store_true", help="input is a folder of CSV files")
    sample.add_argument("--limit", type=_positive, required=True)
    sample.add_argument("--seed", type=int, default=42)
    sample.add_argument("--output", required=True)

    check = job("check-sample", "check a sampled CSV", lake=False)
    check.add_argument("--input", required=True)
    check.add_argument("--rows", type=_positive, required=True)

    replay = job("replay", "send a sampled CSV to a topic", lake=False)
    replay.add_argument("--input", required=True)
    replay.add_argument("--limit", type=_positive)
    replay.add_argument("--partitions", type=_positive, default=4)
    topic_options(replay)

    for name, about in (("ingest", "drain a topic into bronze"), ("run", "everything up to validated gold")):
        added = job(name, about)
        topic_options(added)
        added.add_argument("--start", choices=("earliest", "latest"), default="earliest")
        added.add_argument("--files-per-batch", type=_positive, help="with --files: limit of one batch")
        added.add_argument("--records-per-batch", type=_positive, default=topic.RECORDS_PER_BATCH)
    jobs.choices["ingest"].add_argument("--reset", action="store_true", help="forget the checkpoint")
    jobs.choices["ingest"].add_argument("--clear", action="store_true", help="with --reset: empty the sinks")

    for name, about in (
        ("silver", "bronze to silver"), ("sessions", "session events and facts"),
        ("product-marts", "purchases and products"), ("funnel-marts", "funnel and abandoned carts"),
        ("gold", "all curated tables"),
    ):
        mode_option(job(name, about))

    jobs.choices["run"].add_argument("--reset", action="store_true", help="empty bronze and build everything anew")
    update = job("update", "bring silver and gold up to date for a range of days")
    for end in ("--since", "--until"):
        update.add_argument(end, type=_day, metavar="YYYY-MM-DD")

    job("compact", "fold the folders of committed batches into one")

    for name in ("verify", "run"):
        added = jobs.choices.get(name) or job(name, "check finished layers")
        for minimum in ("min-bronze-rows", "min-silver-rows", "min-sessions"):
            added.add_argument(f"--{minimum}", type=int, default=1)
    jobs.choices["verify"].add_argument("--gold-only", action="store_true")
    jobs.choices["verify"].add_argument("--skip-bronze", action="store_true")

    gated = job("quality-gate", "the release gate: structure, presence, drift, sample and all suites in one report")
    gated.add_argument("--sample", help="the sampled CSV to check as well")
    gated.add_argument("--rows", type=_positive, default=1_000_000, help="rows that the sample should have")
    gated.add_argument("--min-rows", type=int, default=1_000_000, help="rows that bronze and silver should have at least")
    gated.add_argument("--milestones", help="JSON file: metric to [value, tolerance], in place of the known numbers")
    gated.add_argument("--skip-suites", action="store_true", help="take the status of the last verify")

    out = job("publish", "copy the curated layer")
    out.add_argument("--target", required=True)
    out.add_argument("--prefix", default=S.CURATED_PREFIX)
    out.add_argument("--dry-run", action="store_true")
    served = job("serve", "publish, load, build marts and test them")
    served.add_argument("--target", required=True)
    return top


def _stream(spark: SparkSession, args) -> DataFrame:
    if args.files:
        return topic.read_files(spark, args.files, args.files_per_batch)
    if not args.servers:
        raise SystemExit("either --servers or --files is needed")
    return topic.read_kafka(spark, args.servers, args.topic, args.start, args.records_per_batch)


def _sample(spark: SparkSession, args) -> int:
    if args.input:
        source = csv_events.read_csv_events(spark, args.input, folder=args.folder)
    else:
        source = csv_events.read_default_source(spark, args.source_folder)
    drawn = fixed_size_sample(source, args.limit, args.seed)
    csv_events.write_csv_events(stamp_event_ids(drawn.rows, args.seed), args.output)
    print(f"scanned {drawn.scanned:,} rows, wrote {min(drawn.scanned, args.limit):,} to {args.output}")
    if drawn.short:
        print(f"warning: the source has fewer than {args.limit:,} rows", file=sys.stderr)
    return 0


def _replay(spark: SparkSession, args) -> int:
    rows = csv_events.read_csv_events(spark, args.input, S.SAMPLE_CSV)
    # The number that a sampled id ends in orders the rows, not the id's text; rows are sorted only
    # when a limit asks for the first of them.
    number = F.regexp_extract("event_id", r"_(\d+)$", 1)
    numbered = rows.withColumn("_row", number.try_cast("bigint"))
    if args.limit:
        numbered = first_rows(numbered, args.limit, "_row")
    records = topic.encode(numbered, F.coalesce("_row", F.monotonically_increasing_id()))
    if args.files:
        topic.write_files(records, args.files, args.topic, args.partitions)
    elif args.servers:
        topic.write_kafka(records, args.servers, args.topic)
    else:
        raise SystemExit("either --servers or --files is needed")
    return 0


def _gate(spark: SparkSession, args, lake: Lake) -> int:
    sample = csv_events.read_csv_events(spark, args.sample, S.SAMPLE_CSV) if args.sample else None
    expected = S.MILESTONES
    if args.milestones:
        with open(args.milestones, encoding="utf-8") as file:
            expected = {name: tuple(pair) for name, pair in json.load(file).items()}
    report = medallion.quality_gate(spark, lake, sample, args.rows, args.min_rows, expected, args.skip_suites)
    failed = _show(report, "section")
    print("PASSED" if not failed else "FAILED")
    return failed


def _show(checks: DataFrame, group: str = "suite") -> int:
    """Print checks (a bounded report) and return the exit code."""
    rows = checks.collect()
    for row in rows:
        print(f"[{row.status}] {row[group]}.{row.check}: {row.violations}")
    return int(any(row.status == "FAIL" for row in rows))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or start(f"shoptrail-{args.job}")
    shared_dir(spark)
    lake = Lake(args.lake.rstrip("/")) if "lake" in args else None
    minimums = {
        name: getattr(args, name) for name in ("min_bronze_rows", "min_silver_rows", "min_sessions") if name in args
    }
    if args.job == "sample":
        return _sample(spark, args)
    if args.job == "replay":
        return _replay(spark, args)
    if args.job == "check-sample":
        rows = csv_events.read_csv_events(spark, args.input, S.SAMPLE_CSV)
        return _show(suites.sample_file(rows, args.rows))
    if args.job == "ingest":
        print(medallion.ingest(_stream(spark, args), lake, reset=args.reset, clear_outputs=args.clear))
        return 0
    if args.job == "run":
        if args.reset and args.start == "latest":
            raise SystemExit("--reset empties bronze, which a start at the latest records could not fill again")
        report = medallion.run(spark, lake, _stream(spark, args), args.reset, **minimums)
        print(report)
        return int(report["status"] != "PASS")
    if args.job == "update":
        print(medallion.update(spark, lake, args.since, args.until))
        return 0
    if args.job == "compact":
        print(medallion.compact(spark, lake))
        return 0
    if args.job == "verify":
        scope = {"gold_only": args.gold_only, "skip_bronze": args.skip_bronze}
        status = medallion.verify(spark, lake, **scope, **minimums)
        print(status)
        return int(status != "PASS")
    if args.job == "quality-gate":
        return _gate(spark, args, lake)
    if args.job == "publish":
        print(publish.publish(spark, lake.gold, args.target, args.prefix, args.dry_run))
        return 0
    if args.job == "serve":
        served = medallion.serve(spark, lake, args.target)
        failed = served.tests.where("status = 'FAIL'").collect()
        print(served.published, served.tables, failed)
        return int(bool(failed))
    build = {
        "silver": medallion.build_silver,
        "sessions": medallion.build_sessions,
        "product-marts": medallion.build_product_marts,
        "funnel-marts": medallion.build_funnel_marts,
        "gold": medallion.build_gold,
    }[args.job]
    print(build(spark, lake, args.mode))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
