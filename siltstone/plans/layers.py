"""Base table load, typed layer, marts, and the checks across layers."""

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import deltas, marts, merge, quality, staging
from siltstone.operators.control import manifest_gate
from siltstone.operators.deltas import Changes
from siltstone.operators.quality import ModelTests, QualityError, require_empty
from siltstone.operators.standardize import enrich, incident_fact, standardize
from siltstone.plans.lake import Lake
from siltstone.plans.touched import merge_touched, replaced_keys
from siltstone.sources.landing import scan_batch, scan_manifest
from siltstone.sources.tables import staged


@dataclass(frozen=True)
class LoadReport:
    """What a base table load did; ``merged`` is None when nothing was compared.

    ``changes`` holds the rows of touched keys before and after a merge in parts.
    """

    incoming: int
    deduplicated: int
    merged: int | None
    saved: int
    committed: bool
    changes: Changes | None = field(default=None, compare=False)


def load_base(
    lake: Lake,
    prefix: str,
    *,
    run_id: str,
    dataset_id: str,
    full_snapshot: bool = False,
    json_lines: bool = False,
    compare: str = merge.TYPED,
    ingested_at: datetime | None = None,
) -> LoadReport:
    """Check, deduplicate and apply one landed batch to the base table.

    A full snapshot replaces the table and needs a matching manifest, an
    incremental batch is merged, and a batch that changes nothing makes no commit.
    """
    incoming = staging.stage_batch(
        scan_batch(lake.spark, prefix, json_lines=json_lines),
        dataset_id=dataset_id,
        run_id=run_id,
        ingested_at=ingested_at or datetime.now(timezone.utc),
        source_prefix=prefix,
    )
    profile = check_batch(incoming, full_snapshot, compare)
    if full_snapshot:
        _require_manifest(lake, prefix, run_id, profile["incoming_count"])
    return apply_batch(lake, incoming, profile, full_snapshot, compare)


def check_batch(
    incoming: DataFrame, full_snapshot: bool = False, compare: str = merge.TYPED
) -> Row:
    """The counts of a staged batch; raises when a gate fails."""
    if compare == merge.TYPED:
        require_empty(
            staging.unparsable_times(incoming), "Update times that are not instants."
        )
    counts = staged(staging.batch_profile(incoming), "profile")
    require_empty(
        staging.batch_problems(counts, full_snapshot), "The batch is not loadable."
    )
    return counts.first()


def apply_batch(
    lake: Lake,
    incoming: DataFrame,
    profile: Row,
    full_snapshot: bool = False,
    compare: str = merge.TYPED,
) -> LoadReport:
    """Deduplicate a checked batch, write the new table, verify it, then commit it."""
    kept = staging.dedupe_latest(incoming)
    if full_snapshot or not lake.bronze.exists():
        return _replace_base(lake, kept, profile)
    updates = staged(kept, "updates")
    if lake.in_parts:
        found = merge_touched(lake.bronze, updates, compare=compare)
        return LoadReport(
            incoming=profile["incoming_count"],
            deduplicated=profile["deduplicated_count"],
            merged=found.merged,
            saved=lake.bronze.latest()["record_count"],
            committed=found.merged > 0,
            changes=found.changes,
        )
    bucketed = lake.bronze.buckets > 0
    small = not bucketed and merge.fits_broadcast(updates)
    target = lake.bronze.read()
    merged = merge.merge_candidates(
        updates, target, compare=compare, small_updates=small
    ).count()
    written = None
    stored, saved = target, lake.bronze.latest()["record_count"]
    if merged > 0:
        written = lake.bronze.write(
            merge.upsert(target, updates, compare=compare, small_updates=small),
            keeps_buckets=bucketed,
        )
        stored = lake.spark.read.parquet(written)
        saved = stored.count()
    require_empty(
        merge.unapplied_rows(updates, stored, compare=compare, small_updates=small),
        "Incoming records were not applied to the base table.",
    )
    if written is not None:
        lake.bronze.commit(written)
    return LoadReport(
        incoming=profile["incoming_count"],
        deduplicated=profile["deduplicated_count"],
        merged=merged,
        saved=saved,
        committed=written is not None,
    )


def _replace_base(lake: Lake, kept: DataFrame, profile: Row) -> LoadReport:
    """Write the batch once as the whole table; its rows are counted before they count."""
    folder = lake.bronze.write(kept)
    saved = lake.spark.read.schema(kept.schema).parquet(folder).count()
    if saved != profile["deduplicated_count"]:
        raise QualityError(
            f"The base table holds {saved} records, the batch "
            f"{profile['deduplicated_count']}."
        )
    if lake.in_parts:
        lake.bronze.commit(lake.bronze.counted(folder, kept.schema), kept.schema)
    else:
        lake.bronze.commit(folder)
    return LoadReport(
        incoming=profile["incoming_count"],
        deduplicated=profile["deduplicated_count"],
        merged=None,
        saved=saved,
        committed=True,
    )


def _require_manifest(lake: Lake, prefix: str, run_id: str, records: int) -> None:
    actual = lake.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(records).alias("actual_record_count")
    )
    manifest = scan_manifest(lake.spark, prefix).withColumn("run_id", F.lit(run_id))
    refused = manifest_gate(manifest, actual).filter("verdict <> 'ACCEPTED'")
    require_empty(refused, "A full snapshot needs a matching SUCCESS manifest.")


def _base_version(lake: Lake) -> int:
    return lake.bronze.latest()["version"]


def _store_dated(lake: Lake, table, rows: DataFrame) -> int:
    version = _base_version(lake)
    if lake.in_parts:
        return table.replace(rows, source_version=version)
    return table.replace(
        rows, year_of="occ_date", year_column="occ_year", source_version=version
    )


def _store_mart(lake: Lake, table, rows: DataFrame, measures: tuple[str, ...]) -> int:
    """Write a mart, refuse groups below zero, then commit it."""
    by_year = {} if table is lake.summary else {"year_of": "occ_month"}
    if by_year:
        by_year["year_column"] = "occ_year"
    folder = table.write(rows, **by_year)
    require_empty(
        deltas.negative_groups(lake.spark.read.parquet(folder), measures),
        "A change took more from a group than it had.",
    )
    return table.commit(folder, _base_version(lake))


def build_silver(lake: Lake) -> int:
    return _store_dated(lake, lake.silver, standardize(lake.bronze.read()))


def build_gold(lake: Lake) -> int:
    return lake.summary.replace(
        marts.monthly_summary(lake.silver.read()), source_version=_base_version(lake)
    )


def build_fact(lake: Lake) -> int:
    return _store_dated(lake, lake.fact, incident_fact(enrich(lake.silver.read())))


def _build_trends(lake: Lake) -> int:
    trends = marts.monthly_trends(lake.fact.read())
    return _store_mart(lake, lake.trends, trends, marts.TREND_MEASURES)


def _build_rates(lake: Lake) -> int:
    rates = marts.clearance_rates(lake.fact.read())
    return _store_mart(lake, lake.rates, rates, deltas.RATE_MEASURES)


def build_models(lake: Lake) -> dict[str, int]:
    """Fact and marts, independent of the gold summary."""
    return {
        "fact": build_fact(lake),
        "trends": _build_trends(lake),
        "rates": _build_rates(lake),
    }


def refresh(lake: Lake, changes: Changes | None = None) -> dict[str, str]:
    """Bring every layer to the version of the base table; says how for each.

    A layer made from the version before the change set takes the difference: the
    years that it touches, or the groups. One that is older, as after a run that
    failed half-way, is built from scratch, and one that is there already is left.
    """
    version = _base_version(lake)
    typed = changes and changes.mapped(standardize)
    facts = typed and typed.mapped(lambda rows: incident_fact(enrich(rows)))

    def store(table, stored_rows, measures):
        return lambda: _store_mart(lake, table, stored_rows(), measures)

    def summary():
        return deltas.changed_summary(lake.summary.read(), deltas.summary_delta(typed))

    def trends():
        return deltas.changed_summary(lake.trends.read(), deltas.trends_delta(facts))

    def rates():
        return deltas.changed_rates(lake.rates.read(), deltas.rates_delta(facts))

    steps = {
        "silver": (lake.silver, build_silver, lambda: replaced_keys(lake.silver, typed, version)),
        "fact": (lake.fact, build_fact, lambda: replaced_keys(lake.fact, facts, version)),
        "summary": (lake.summary, build_gold, store(lake.summary, summary, marts.TREND_MEASURES)),
        "trends": (lake.trends, _build_trends, store(lake.trends, trends, marts.TREND_MEASURES)),
        "rates": (lake.rates, _build_rates, store(lake.rates, rates, deltas.RATE_MEASURES)),
    }
    done = {}
    for name, (table, build, change) in steps.items():
        latest = table.latest()
        made_from = latest and latest["source_version"]
        if made_from == version:
            done[name] = "current"
        elif changes is not None and made_from == changes.base_version:
            change()
            done[name] = "changed"
        else:
            build(lake)
            done[name] = "built"
    return done


SILVER_TESTS = ModelTests(
    not_null=(V.ROW_ID, V.BUSINESS_KEY), unique=(V.ROW_ID, V.BUSINESS_KEY)
)
FACT_TESTS = ModelTests(
    not_null=(V.BUSINESS_KEY, "incident_count"),
    unique=(V.BUSINESS_KEY,),
    accepted=(("incident_count", (1,)),),
    sums=("incident_count",),
)


def check_models(lake: Lake) -> None:
    """The model tests: keys, constants, totals and balances; one scan a table."""
    problems = []
    for table, tests in ((lake.silver, SILVER_TESTS), (lake.fact, FACT_TESTS)):
        rows = table.read()
        profile = quality.model_profile(rows, tests).first()
        problems += quality.model_violations(rows, tests, profile)
    incidents = lake.trends.read().agg(F.sum("incident_count")).first()[0]
    if incidents != profile["sum_incident_count"]:
        problems.append(
            f"Totals differ: fact {profile['sum_incident_count']}, mart {incidents}."
        )
    if problems:
        raise QualityError(" ".join(problems))
    require_empty(
        quality.clearance_imbalance(lake.rates.read()), "Clearance counts do not add up."
    )


def validate_layers(lake: Lake) -> None:
    """Equal totals in every layer, and equal monthly aggregates built both ways."""
    counts = quality.layer_counts(
        base=lake.bronze.read(),
        clean=lake.silver.read(),
        summary=lake.summary.read(),
        fact=lake.fact.read(),
        mart=lake.trends.read(),
    )
    require_empty(counts.filter(~F.col("layers_agree")), "Layer totals differ.")
    require_empty(
        quality.bag_diff(lake.summary.read(), lake.trends.read()),
        "Summary and mart differ.",
    )
