"""Command line of the jobs, for spark-submit.

    spark-submit run_job.py --lake-root <uri> --raw-root <uri> bronze <run_id>
"""

import argparse
import os

from siltstone.operators import marts, profile
from siltstone.plans import layers, reconciliation, runs
from siltstone.plans.lake import Lake
from siltstone.session import build_session
from siltstone.sources import landing
from siltstone.sources.expiry import expire
from siltstone.sources.tables import partition_stats, preview, release_staged


def bronze(lake: Lake, args) -> None:
    report = layers.load_base(
        lake,
        landing.batch_path(args.raw_root, args.run_id),
        run_id=args.run_id,
        dataset_id=args.dataset_id,
        full_snapshot=args.full_snapshot,
        json_lines=args.json_lines,
        compare=args.compare,
    )
    print(f"Incoming count: {report.incoming}")
    print(f"Deduplicated count: {report.deduplicated}")
    print(f"Duplicates removed: {report.incoming - report.deduplicated}")
    if report.merged is not None:
        print(f"Records requiring merge: {report.merged}")
    print(f"Saved count: {report.saved}")
    lake.bronze.history().orderBy("version").show(truncate=False)


def silver(lake: Lake, args) -> None:
    print(f"Saved count: {layers.build_silver(lake)}")
    clean = lake.silver.read()
    clean.printSchema()
    if lake.in_parts:
        lake.silver.parts().orderBy("part").show(30, truncate=False)
    else:
        partition_stats(clean, "occ_year").orderBy("occ_year").show(30)


def gold(lake: Lake, args) -> None:
    print(f"Saved count: {layers.build_gold(lake)}")
    summary = lake.summary.read()
    marts.latest_months(summary, 20).show(20, truncate=False)
    marts.control_totals(summary).show()


def models(lake: Lake, args) -> None:
    print(f"Saved counts: {layers.build_models(lake)}")
    layers.check_models(lake)


def validate(lake: Lake, args) -> None:
    layers.validate_layers(lake)
    print("Layer validation passed.")


def inspect(lake: Lake, args) -> None:
    base = lake.bronze.read()
    preview(base, ["incident_report_number", "crime_type", "ingestion_run_id"])
    for report in (
        profile.key_profile,
        profile.duplicate_keys,
        profile.date_coverage,
        profile.status_breakdown,
        profile.value_frequency,
        profile.date_sample,
    ):
        report(base).show(truncate=False)


def inspect_raw(lake: Lake, args) -> None:
    prefix = landing.batch_path(args.raw_root, args.run_id)
    raw = landing.scan_batch(lake.spark, prefix, json_lines=args.json_lines)
    preview(raw, raw.columns)
    print(f"Record count: {raw.count()}")


def reconcile(lake: Lake, args) -> None:
    prefix = landing.batch_path(args.raw_root, args.run_id)
    result = reconciliation.compare_keys(lake, prefix, json_lines=args.json_lines)
    for name, value in result.summary.asDict().items():
        print(f"{name}: {value}")
    reconciliation.require_agreement(lake, result)


def daily(lake: Lake, args) -> None:
    source = lake.spark.read.parquet(args.source)
    load = runs.bootstrap if args.bootstrap else runs.daily_load
    print(
        load(
            lake,
            source,
            dataset_id=args.dataset_id,
            landing_root=args.raw_root,
            run_id=args.run_id,
        )
    )


def expire_tables(lake: Lake, args) -> None:
    for name, table in lake.tables().items():
        print(f"{name}: {len(expire(table, args.keep))} folders deleted")


def history(lake: Lake, args) -> None:
    runs.recent_runs(lake).show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="siltstone.jobs")
    parser.add_argument("--lake-root", default=os.getenv("LAKE_ROOT"))
    parser.add_argument("--raw-root", default=os.getenv("RAW_ROOT"))
    parser.add_argument("--dataset-id", default="incidents")
    parser.add_argument("--base-buckets", type=int, default=0)
    parser.add_argument("--key-buckets", type=int, default=0)
    jobs = parser.add_subparsers(required=True)
    for job in (silver, gold, models, validate, inspect, history):
        jobs.add_parser(job.__name__).set_defaults(job=job)
    command = jobs.add_parser("expire")
    command.set_defaults(job=expire_tables)
    command.add_argument("--keep", type=int, default=7)
    for job in (bronze, inspect_raw, reconcile, daily):
        command = jobs.add_parser(job.__name__.replace("_", "-"))
        command.set_defaults(job=job)
        command.add_argument("run_id")
        command.add_argument("--json-lines", action="store_true")
        if job is bronze:
            command.add_argument("--full-snapshot", action="store_true")
            command.add_argument("--compare", choices=["typed", "text"], default="typed")
        if job is daily:
            command.add_argument("--source", required=True)
            command.add_argument("--bootstrap", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if not args.lake_root:
        parser.error("--lake-root or LAKE_ROOT is required")
    spark = build_session()
    try:
        lake = Lake(
            spark,
            args.lake_root,
            base_buckets=args.base_buckets,
            key_buckets=args.key_buckets,
        )
        args.job(lake, args)
        # Names given before follow the tables that the job wrote.
        lake.publish(only_named=True)
    finally:
        release_staged(spark)
        spark.stop()
