"""Full comparison of the source keys with the base table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone import values as V
from siltstone.functions.parsing import instant_of
from siltstone.operators import control, fingerprints, reconcile
from siltstone.operators.quality import require_empty
from siltstone.plans.lake import Lake
from siltstone.sources import changes, landing
from siltstone.sources.tables import staged


@dataclass(frozen=True)
class Reconciliation:
    """The summary row, and the keys behind its counts for drill-down."""

    summary: Row
    missing_from_target: DataFrame
    missing_from_source: DataFrame
    timestamp_mismatches: DataFrame


def land_source_keys(
    source: DataFrame, *, dataset_id: str, landing_root: str, run_id: str
) -> dict:
    """Land key, row id and update time of the whole source, up to its latest time."""
    spark = source.sparkSession
    timed = source.withColumn("_time", instant_of(source, ":updated_at"))
    total = changes.source_summary(timed, "_time").first()
    prefix = landing.batch_path(landing_root, run_id)
    # Rows that changed after the summary wait for the next reconciliation.
    bounded = timed.filter(F.col("_time") <= F.lit(total["max_updated_at"]))
    keys = bounded.select(*schemas.RAW_KEYS.fieldNames())
    landing.write_pages(keys, prefix, [V.BUSINESS_KEY, ":id"])
    landing.write_manifest(
        spark,
        prefix,
        run={"run_id": run_id, "dataset_id": dataset_id},
        expected=total["record_count"],
        source_records=total["record_count"],
    )
    return {
        "run_id": run_id,
        "prefix": prefix,
        "record_count": total["record_count"],
        "window_end": total["max_updated_at"],
    }


def check_landed_keys(lake: Lake, prefix: str, run_id: str) -> None:
    """The pages on storage are those the manifest lists, in number and size."""
    pages = landing.page_lines(lake.spark, prefix)
    manifest = landing.scan_manifest(lake.spark, prefix)
    require_empty(
        manifest.filter(~F.col("run_id").eqNullSafe(F.lit(run_id))),
        "The manifest belongs to another run.",
    )
    run = F.lit(run_id).alias("run_id")
    checks = control.manifest_checks(
        manifest,
        landing.scan_entries(lake.spark, prefix).select(run, "*"),
        landing.page_inventory(pages).select(run, "*"),
    )
    require_empty(checks.filter("NOT accepted"), "The key snapshot is not complete.")


def compare_keys(lake: Lake, prefix: str, *, json_lines: bool = True) -> Reconciliation:
    """Compare a landed key snapshot with the base table, which holds a key once.

    Ranges of keys whose fingerprints agree are counted and not opened.
    """
    landed = landing.scan_batch(
        lake.spark, prefix, schemas.RAW_KEYS, json_lines=json_lines
    ).withColumnsRenamed(V.SYSTEM_COLUMNS)
    opened = fingerprints.differing(*_key_columns(landed, lake.bronze.read()))
    # Written once: the counts and each drill-down read it again.
    states = staged(reconcile.key_states(opened[0], opened[1]), "key-states")
    summary = fingerprints.with_equal_rows(
        reconcile.reconcile_summary(states), opened[2]
    )
    return Reconciliation(
        summary=summary.first(),
        missing_from_target=reconcile.missing_from_target(states),
        missing_from_source=reconcile.missing_from_source(states),
        timestamp_mismatches=reconcile.timestamp_mismatches(states),
    )


def _key_columns(*sides: DataFrame) -> list[DataFrame]:
    return [df.select(V.BUSINESS_KEY, V.UPDATED_AT) for df in sides]


def require_agreement(lake: Lake, result: Reconciliation) -> None:
    summary = lake.spark.range(1).select(
        *[F.lit(value).alias(name) for name, value in result.summary.asDict().items()]
    )
    require_empty(
        reconcile.reconcile_problems(summary), "Source and base table differ."
    )


def reconcile_source(
    lake: Lake, source: DataFrame, *, dataset_id: str, landing_root: str, run_id: str
) -> dict:
    """The scheduled comparison; raises when source and table differ."""
    renamed = source.withColumnsRenamed(V.SYSTEM_COLUMNS)
    soft = reconcile.compare_summaries(
        changes.source_summary(renamed), changes.source_summary(lake.bronze.read())
    ).first()
    landed = land_source_keys(
        source, dataset_id=dataset_id, landing_root=landing_root, run_id=run_id
    )
    check_landed_keys(lake, landed["prefix"], run_id)
    result = compare_keys(lake, landed["prefix"])
    require_agreement(lake, result)
    return {**landed, "summaries_match": soft["summaries_match"], "result": result}
