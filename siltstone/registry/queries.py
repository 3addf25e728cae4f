"""One callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone import values as V
from siltstone.functions.parsing import iso_millis
from siltstone.operators import (
    charts,
    control,
    deltas,
    fingerprints,
    marts,
    merge,
    profile,
    quality,
    reconcile,
    staging,
    standardize,
)
from siltstone.plans.touched import merge_touched, replaced_keys
from siltstone.registry import inputs as given
from siltstone.sources import changes, landing
from siltstone.sources.events import EventTable
from siltstone.sources.pages import KeyPages
from siltstone.sources.parts import PartTable
from siltstone.sources.tables import (
    VersionedTable,
    partition_stats,
    staged,
    with_year_range,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2001, 7, 15)
NOW = "2002-06-01"


def query(make: Query) -> Query:
    """Register a query under its function name.

    Instants come out without a zone, so a comparison does not depend on the zone
    of the reading process.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        result = make(spark, sf_dir)
        zoned = [f.name for f in result.schema if f.dataType == T.TimestampType()]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[make.__name__] = run
    return make


def _moment(text: str):
    return F.lit(text).cast("timestamp")


# Landed batches and manifests


@query
def raw_scan(spark, sf_dir):
    """Records written as pages and scanned back with the declared schema."""
    prefix = given.fresh_path(spark, "pages")
    raw = given.raw_incidents(spark, sf_dir)
    landing.write_pages(raw, prefix, [":updated_at", ":id"])
    return landing.scan_batch(spark, prefix, json_lines=True)


def _landed_events(spark, sf_dir):
    """Events landed as pages, with the inventory and manifest of the batch."""
    prefix = given.fresh_path(spark, "events")
    rows = given.table(spark, sf_dir, "events")
    landing.write_pages(rows, prefix, ["ts", "event_id"])
    landing.write_manifest(
        spark,
        prefix,
        run={"run_id": given.RUN_ID, "dataset_id": "events"},
        expected=rows.count(),
        source_records=rows.count(),
    )
    return prefix


@query
def landing_manifest(spark, sf_dir):
    prefix = _landed_events(spark, sf_dir)
    stated = [
        "run_id",
        "dataset_id",
        "page_size",
        "expected_record_count",
        "extracted_record_count",
        "status",
    ]
    both = quality.side_by_side(
        stated=landing.scan_manifest(spark, prefix).select(*stated, "pages_downloaded"),
        listed=landing.scan_entries(spark, prefix).agg(
            F.count(F.lit(1)).alias("pages"), F.max("record_count").alias("largest")
        ),
    )
    return both.select(
        *[F.col(f"stated_{name}").alias(name) for name in stated],
        (F.col("listed_largest") <= V.PAGE_SIZE).alias("pages_within_size"),
        (F.col("listed_pages") == F.col("stated_pages_downloaded")).alias(
            "pages_listed"
        ),
    )


def _landed_runs(spark, sf_dir):
    """Events landed as one run per event type, and a manifest for most runs."""
    prefix = given.fresh_path(spark, "runs")
    rows = given.event_datasets(spark, sf_dir).withColumnRenamed("dataset_id", "run_id")
    (
        rows.write.partitionBy("run_id")
        .option("maxRecordsPerFile", V.PAGE_SIZE)
        .json(prefix)
    )
    pages = spark.read.schema(rows.schema).json(prefix)
    inventory = pages.groupBy(
        "run_id",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
    ).agg(F.count(F.lit(1)).alias("record_count"))
    run = F.col("run_id")
    size = F.col("file_size_bytes")
    entries = inventory.filter(run != "view").withColumns(
        {
            "file_size_bytes": F.when(run == "error", size + 1).otherwise(size),
            "times": F.when(run == "click", 2).otherwise(1),
        }
    )
    manifests = entries.groupBy("run_id").agg(
        F.sum("record_count").alias("extracted_record_count"),
        F.count(F.lit(1)).alias("pages_downloaded"),
        (
            F.sum("record_count") + F.when(run == "click", 1).otherwise(0)
        ).alias("expected_record_count"),
        F.when(run == "purchase", V.PARTIAL).otherwise(V.SUCCESS).alias("status"),
    )
    listed = entries.withColumn(
        "times", F.explode(F.sequence(F.lit(1), F.col("times")))
    ).drop("times")
    return inventory, manifests, listed


@query
def manifest_gate(spark, sf_dir):
    inventory, manifests, _ = _landed_runs(spark, sf_dir)
    counts = inventory.groupBy("run_id").agg(
        F.sum("record_count").alias("actual_record_count")
    )
    return control.manifest_gate(manifests, counts)


@query
def manifest_files(spark, sf_dir):
    inventory, manifests, listed = _landed_runs(spark, sf_dir)
    return control.manifest_checks(manifests, listed, inventory).select(
        "run_id",
        "names_unique",
        "pages_match",
        "records_match",
        (F.col("file_problems") > 0).alias("has_file_problems"),
        "accepted",
    )


@query
def manifest_total(spark, sf_dir):
    _, _, listed = _landed_runs(spark, sf_dir)
    return control.manifest_totals(listed).select("run_id", "listed_records")


@query
def extraction_status(spark, sf_dir):
    """Status of each order's batch, its line items being the extracted records."""
    order = F.col("l_orderkey")
    pages = F.max("l_linenumber").cast("long")
    counted = (
        given.table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("extracted"), pages.alias("pages"))
    )
    expected = order % 7 + 1
    cap = F.when(order % 3 == 0, 5).cast("long")
    found = F.col("extracted")
    return counted.select(
        "l_orderkey",
        landing.extraction_status(expected, found, F.col("pages"), cap).alias("status"),
        landing.bootstrap_status(expected, found, cap).alias("bootstrap_status"),
    )


@query
def file_ledger_upsert(spark, sf_dir):
    return control.register_files(
        given.file_ledger(spark, sf_dir), given.uploaded_files(spark, sf_dir)
    )


@query
def page_checksums(spark, sf_dir):
    """Size and content digest of landed files: the customers of each nation."""
    folder = given.fresh_path(spark, "pages")
    (
        given.table(spark, sf_dir, "customer")
        .repartition("c_nationkey")
        .sortWithinPartitions("c_nationkey", "c_custkey")
        .select("c_nationkey", F.concat_ws(" ", "c_custkey", "c_name").alias("value"))
        .write.partitionBy("c_nationkey")
        .text(folder)
    )
    found = landing.page_checksums(spark, f"{folder}/*/part*")
    nation = F.regexp_extract("object_path", r"([^/]+)/[^/]+$", 1)
    return found.select(nation.alias("folder"), "file_size_bytes", "checksum_sha256")


@query
def file_ledger_events(spark, sf_dir):
    """The same ledger as events: registered, registered anew, compacted in between."""
    ledger = EventTable(
        spark,
        given.fresh_path(spark, "ledger"),
        schemas.FILE_LEDGER,
        ["extract_batch_id", "object_path"],
    )
    ledger.append(given.file_ledger(spark, sf_dir), "known")
    uploads = given.uploaded_files(spark, sf_dir)
    for page in (0, 1):
        some = uploads.filter(F.crc32(F.col("object_path").cast("binary")) % 2 == page)
        ledger.append(control.register_files(ledger.read(some), some), f"batch {page}")
        if page == 0:
            ledger.compact()
    return ledger.read()


# Queries on the source


@query
def source_summary(spark, sf_dir):
    return changes.source_summary(given.table(spark, sf_dir, "events"), "ts")


@query
def change_window(spark, sf_dir):
    events = given.table(spark, sf_dir, "events")
    return changes.change_window(events, datetime(2024, 1, 10), "ts")


@query
def change_window_pages(spark, sf_dir):
    events = given.table(spark, sf_dir, "events")
    changed = changes.window_rows(
        events, datetime(2024, 1, 5), datetime(2024, 1, 28), "ts"
    )
    pages = changes.number_pages(changed, ["ts", "event_id"], page_size=1000)
    return pages.select("event_id", "ts", "page_number")


@query
def keyset_page(spark, sf_dir):
    orders = given.table(spark, sf_dir, "orders")
    return changes.keyset_page(orders, F.col("o_orderkey"), after=999)


@query
def keyset_page_directory(spark, sf_dir):
    """The same page from the files that the directory names for it."""
    pages = KeyPages(spark, given.fresh_path(spark, "by-key"), "o_orderkey")
    pages.write(given.table(spark, sf_dir, "orders"), page_size=1000)
    return pages.page(after=999)


@query
def key_snapshot(spark, sf_dir):
    orders = given.table(spark, sf_dir, "orders")
    return changes.key_snapshot(
        orders, datetime(2001, 1, 1), "o_orderkey", "o_custkey", "o_orderdate"
    )


@query
def iso_text(spark, sf_dir):
    events = given.table(spark, sf_dir, "events")
    moment = F.col("ts").cast("timestamp")
    return events.select("event_id", iso_millis(moment).alias("ts_text"))


@query
def load_mode(spark, sf_dir):
    return control.load_modes(
        given.event_datasets(spark, sf_dir),
        given.event_watermarks(spark, sf_dir),
        "dataset_id",
        "ts",
    )


@query
def run_outcomes(spark, sf_dir):
    modes = control.load_modes(
        given.event_datasets(spark, sf_dir),
        given.event_watermarks(spark, sf_dir),
        "dataset_id",
        "ts",
    )
    return control.run_outcomes(modes)


# Staging


@query
def bronze_stage(spark, sf_dir):
    return given.base_incidents(spark, sf_dir)


@query
def batch_profile(spark, sf_dir):
    return staging.batch_profile(given.repeated_batch(spark, sf_dir))


@query
def missing_keys(spark, sf_dir):
    return staging.missing_keys(given.repeated_batch(spark, sf_dir))


@query
def batch_problems(spark, sf_dir):
    counts = staging.batch_profile(given.repeated_batch(spark, sf_dir))
    return staging.batch_problems(counts, full_snapshot=True)


@query
def dedupe_latest(spark, sf_dir):
    return staging.dedupe_latest(given.repeated_batch(spark, sf_dir))


# Merge


@query
def merge_candidates(spark, sf_dir):
    return merge.merge_candidates(
        given.merge_updates(spark, sf_dir), given.merge_target(spark, sf_dir)
    )


@query
def merge_candidates_text(spark, sf_dir):
    return merge.merge_candidates(
        given.merge_updates(spark, sf_dir),
        given.merge_target(spark, sf_dir),
        compare=merge.TEXT,
    )


@query
def unapplied_rows(spark, sf_dir):
    return merge.unapplied_rows(
        given.merge_updates(spark, sf_dir), given.merge_target(spark, sf_dir)
    )


@query
def upsert(spark, sf_dir):
    return merge.upsert(
        given.merge_target(spark, sf_dir), given.merge_updates(spark, sf_dir)
    )


@query
def upsert_small_batch(spark, sf_dir):
    """The same merge, its join chosen by the measured size of the updates."""
    updates = given.merge_updates(spark, sf_dir)
    return merge.upsert(
        given.merge_target(spark, sf_dir),
        updates,
        small_updates=merge.fits_broadcast(updates),
    )


@query
def upsert_bucketed(spark, sf_dir):
    """The same merge into a table bucketed by its key."""
    table = VersionedTable(
        spark,
        given.fresh_path(spark, "bucketed"),
        bucket_key=V.BUSINESS_KEY,
        buckets=16,
    )
    table.replace(given.merge_target(spark, sf_dir))
    return merge.upsert(table.read(), given.merge_updates(spark, sf_dir))


def _in_parts(spark, rows):
    path = given.fresh_path(spark, "in-parts")
    table = PartTable.by_key(spark, path, V.BUSINESS_KEY, 16)
    table.replace(rows)
    return table


@query
def upsert_touched_buckets(spark, sf_dir):
    """The same merge into a table in key buckets: buckets without changes stay."""
    table = _in_parts(spark, given.merge_target(spark, sf_dir))
    merge_touched(table, staged(given.merge_updates(spark, sf_dir), "updates"))
    return table.read()


def _typed_changes(spark, sf_dir):
    """The base table, and what two batches of moved incidents change in it."""
    table = _in_parts(spark, given.base_incidents(spark, sf_dir))
    base = table.read()

    def changed():
        for number in (1, 2):
            batch = staged(given.moved_batch(spark, sf_dir, number), "updates")
            yield merge_touched(table, batch).changes.mapped(standardize.standardize)

    return standardize.standardize(base), changed()


@query
def silver_touched_years(spark, sf_dir):
    """Typed rows in parts by year; each batch rewrites the years it touches."""
    clean, changed = _typed_changes(spark, sf_dir)
    table = PartTable.by_year(spark, given.fresh_path(spark, "by-year"), "occ_date")
    table.replace(clean)
    for change in changed:
        replaced_keys(table, change)
    return table.read()


@query
def summary_by_deltas(spark, sf_dir):
    """The monthly summary, kept by what two batches add and take."""
    clean, changed = _typed_changes(spark, sf_dir)
    summary = staged(marts.monthly_summary(clean), "summary")
    for change in changed:
        summary = deltas.changed_summary(summary, deltas.summary_delta(change))
    return summary


@query
def rates_by_deltas(spark, sf_dir):
    """Clearance rates from the fact, kept by what two batches add and take."""
    clean, changed = _typed_changes(spark, sf_dir)
    rates = staged(marts.clearance_rates(given.as_fact(clean)), "rates")
    for change in changed:
        rates = deltas.changed_rates(rates, deltas.rates_delta(change.mapped(given.as_fact)))
    return rates


@query
def upsert_idempotent(spark, sf_dir):
    """Applying the same updates again finds nothing to do."""
    target = given.merge_target(spark, sf_dir)
    updates = given.merge_updates(spark, sf_dir)
    table = VersionedTable(spark, given.fresh_path(spark, "merged"))
    table.replace(merge.upsert(target, updates))
    merged = table.read()
    rows = F.count(F.lit(1)).alias("rows")
    return quality.side_by_side(
        first=merge.merge_candidates(updates, target).agg(rows),
        again=merge.merge_candidates(updates, merged).agg(rows),
        unapplied=merge.unapplied_rows(updates, merged).agg(rows),
        merged=merged.agg(rows),
    )


@query
def snapshot_replace(spark, sf_dir):
    """A table replaced by a later snapshot: keys the snapshot lacks are gone."""
    table = VersionedTable(spark, given.fresh_path(spark, "snapshot"))
    table.replace(given.base_incidents(spark, sf_dir))
    table.replace(given.later_snapshot(spark, sf_dir))
    return table.read()


@query
def commit_history(spark, sf_dir):
    table = VersionedTable(spark, given.fresh_path(spark, "history"))
    table.replace(given.merge_target(spark, sf_dir))
    table.replace(merge.upsert(table.read(), given.merge_updates(spark, sf_dir)))
    return table.history().select("version", "operation", "record_count")


@query
def snapshot_diff(spark, sf_dir):
    return merge.snapshot_diff(
        given.base_incidents(spark, sf_dir),
        given.later_snapshot(spark, sf_dir),
        V.BUSINESS_KEY,
        ["crime_type", "occ_date", "clearance_status", "council_district", "sector"],
        [V.UPDATED_AT, V.VERSION, V.ROW_ID],
    )


@query
def version_diff(spark, sf_dir):
    """The same difference between two stored versions, by the parts that differ."""
    table = _in_parts(spark, given.base_incidents(spark, sf_dir))
    table.replace(given.later_snapshot(spark, sf_dir))
    return merge.version_diff(
        table,
        1,
        2,
        V.BUSINESS_KEY,
        ["crime_type", "occ_date", "clearance_status", "council_district", "sector"],
        [V.UPDATED_AT, V.VERSION, V.ROW_ID],
    )


# Typed layer, fact and marts


@query
def silver_standardize(spark, sf_dir):
    return given.clean_incidents(spark, sf_dir)


def _clean_by_year(spark, sf_dir):
    table = VersionedTable(spark, given.fresh_path(spark, "clean"))
    clean = given.clean_incidents(spark, sf_dir)
    table.replace(clean, year_of="occ_date", year_column="occ_year")
    return table.read()


@query
def partitioned_write(spark, sf_dir):
    """Rows of a date range, read from the year folders that can hold them."""
    stored = _clean_by_year(spark, sf_dir)
    ranged = with_year_range(
        stored, "occ_date", "occ_year", date(1996, 3, 1), date(1998, 10, 31)
    )
    return ranged.select(V.BUSINESS_KEY, "occ_date", "crime_type", "occ_year")


@query
def partitioned_rows(spark, sf_dir):
    """Every row of the year folders, whatever its date."""
    stored = _clean_by_year(spark, sf_dir)
    return stored.select(V.BUSINESS_KEY, "occ_date", "crime_type", "occ_year")


@query
def partition_stats_by_year(spark, sf_dir):
    stats = partition_stats(_clean_by_year(spark, sf_dir), "occ_year")
    has_files = (F.col("file_count") > 0).alias("has_files")
    return stats.select("occ_year", "record_count", has_files)


@query
def enrich_delays(spark, sf_dir):
    return standardize.enrich(given.clean_incidents(spark, sf_dir)).select(
        V.BUSINESS_KEY,
        "occ_date",
        "rep_date",
        "clearance_date",
        "reporting_delay_days",
        "clearance_delay_days",
        "has_date_sequence_issue",
    )


@query
def fact(spark, sf_dir):
    return given.fact(spark, sf_dir)


@query
def monthly_summary(spark, sf_dir):
    return given.summary(spark, sf_dir)


@query
def monthly_trends(spark, sf_dir):
    return given.trends(spark, sf_dir)


@query
def clearance_rates(spark, sf_dir):
    return marts.clearance_rates(given.fact(spark, sf_dir))


@query
def gold_totals(spark, sf_dir):
    return marts.control_totals(given.summary(spark, sf_dir))


@query
def latest_months_top(spark, sf_dir):
    return marts.latest_months(given.summary(spark, sf_dir), V.PREVIEW_ROWS)


# Profiling


@query
def key_profile(spark, sf_dir):
    return profile.key_profile(given.repeated_batch(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(given.repeated_batch(spark, sf_dir))


@query
def date_coverage(spark, sf_dir):
    return profile.date_coverage(given.base_incidents(spark, sf_dir))


@query
def status_breakdown(spark, sf_dir):
    return profile.status_breakdown(given.base_incidents(spark, sf_dir))


@query
def value_frequency(spark, sf_dir):
    return profile.value_frequency(given.base_incidents(spark, sf_dir))


@query
def date_sample(spark, sf_dir):
    return profile.date_sample(
        given.base_incidents(spark, sf_dir),
        columns=(V.BUSINESS_KEY, *profile.DATE_COLUMNS),
        order_by=[V.BUSINESS_KEY],
    )


@query
def distinct_keys(spark, sf_dir):
    keys = given.repeated_batch(spark, sf_dir).select(V.BUSINESS_KEY).distinct()
    return keys.agg(F.count(F.lit(1)).alias("unique_count"))


# Reconciliation


def _key_states(spark, sf_dir):
    return reconcile.key_states(
        given.source_keys(spark, sf_dir), given.table_keys(spark, sf_dir)
    )


@query
def missing_from_target(spark, sf_dir):
    return reconcile.missing_from_target(_key_states(spark, sf_dir))


@query
def missing_from_source(spark, sf_dir):
    return reconcile.missing_from_source(_key_states(spark, sf_dir))


@query
def timestamp_mismatch(spark, sf_dir):
    return reconcile.timestamp_mismatches(_key_states(spark, sf_dir))


@query
def reconcile_summary(spark, sf_dir):
    return reconcile.reconcile_summary(_key_states(spark, sf_dir))


def _opened_states(spark, sf_dir):
    source, target, equal = fingerprints.differing(
        given.source_keys(spark, sf_dir), given.table_keys(spark, sf_dir)
    )
    return reconcile.key_states(source, target), equal


@query
def reconcile_by_ranges(spark, sf_dir):
    """The same summary from the key ranges whose fingerprints differ."""
    states, equal = _opened_states(spark, sf_dir)
    return fingerprints.with_equal_rows(reconcile.reconcile_summary(states), equal)


@query
def mismatch_by_ranges(spark, sf_dir):
    return reconcile.timestamp_mismatches(_opened_states(spark, sf_dir)[0])


@query
def reconcile_profile(spark, sf_dir):
    """The same summary when the source repeats keys and has NULL keys."""
    repeated = given.repeated_batch(spark, sf_dir)
    states = reconcile.key_states(repeated, given.base_incidents(spark, sf_dir))
    return reconcile.reconcile_summary(states).select(
        "source_count",
        "source_unique_count",
        "source_null_keys",
        "target_count",
        "target_unique_count",
        "target_null_keys",
        "missing_from_target",
        "missing_from_source",
    )


@query
def summary_compare(spark, sf_dir):
    source = changes.source_summary(given.base_incidents(spark, sf_dir))
    target = changes.source_summary(given.merge_updates(spark, sf_dir))
    return reconcile.compare_summaries(source, target)


# Quality


@query
def layer_counts(spark, sf_dir):
    clean = given.clean_incidents(spark, sf_dir)
    fact_rows = given.fact(spark, sf_dir)
    return quality.layer_counts(
        base=given.base_incidents(spark, sf_dir),
        clean=clean,
        summary=marts.monthly_summary(clean),
        fact=fact_rows,
        mart=marts.monthly_trends(fact_rows),
    )


@query
def bag_diff(spark, sf_dir):
    """Line items by order and line against a copy with other flags and lines."""
    lines = given.table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    line = F.col("l_linenumber")
    copy = lines.withColumns(
        {
            "l_linenumber": F.when(part % 50 == 1, 1).otherwise(line),
            "l_returnflag": F.when(part % 20 != 3, F.col("l_returnflag")),
        }
    )
    return quality.bag_diff(lines, copy, ["l_suppkey", "l_linenumber", "l_returnflag"])


@query
def bag_diff_counts(spark, sf_dir):
    """The monthly mart built both ways, and against one with another district."""
    summary, trends = given.summary(spark, sf_dir), given.trends(spark, sf_dir)
    moved = trends.withColumn(
        "council_district",
        F.when(F.col("council_district") != 4, F.col("council_district")),
    )
    return quality.side_by_side(
        same=quality.bag_diff_counts(quality.bag_diff(summary, trends)),
        moved=quality.bag_diff_counts(quality.bag_diff(summary, moved)),
    )


@query
def dq_not_null(spark, sf_dir):
    return quality.not_null(
        given.fact(spark, sf_dir),
        [
            "incident_report_number",
            "incident_count",
            "source_row_id",
            "crime_type",
            "occ_date",
            "council_district",
        ],
    )


@query
def dq_unique(spark, sf_dir):
    return quality.unique(given.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(
        given.table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"]
    )


@query
def model_tests(spark, sf_dir):
    """Null, repeated and unknown values and totals of the fact, from one scan."""
    tests = quality.ModelTests(
        not_null=(V.BUSINESS_KEY, "incident_count", "crime_type", "council_district"),
        unique=(V.BUSINESS_KEY, "census_block_group"),
        accepted=(("incident_count", (1,)), ("clearance_status", ("C", "N"))),
        sums=("incident_count", "reporting_delay_days"),
    )
    return quality.model_profile(given.fact(spark, sf_dir), tests)


@query
def totals_match(spark, sf_dir):
    sums = quality.totals(given.fact(spark, sf_dir), given.trends(spark, sf_dir))
    agree = F.col("fact_incidents") == F.col("mart_incidents")
    return sums.withColumn("totals_agree", agree)


@query
def clearance_balance(spark, sf_dir):
    """Imbalances of a clearance mart in which some districts are miscounted."""
    rates = marts.clearance_rates(given.fact(spark, sf_dir))
    wrong = F.when(F.col("council_district") == 3, 1).otherwise(0)
    counted = F.col("known_clearance_count") + wrong
    return quality.clearance_imbalance(
        rates.withColumn("known_clearance_count", counted)
    )


# Control tables

@query
def run_summary(spark, sf_dir):
    return control.run_summary(
        given.runs(spark, sf_dir),
        given.batches(spark, sf_dir),
        given.watermarks(spark, sf_dir),
        _moment(NOW),
    )


@query
def latest_runs(spark, sf_dir):
    latest = control.latest_runs(
        given.runs(spark, sf_dir),
        given.batches(spark, sf_dir),
        given.watermarks(spark, sf_dir),
        _moment(NOW),
    )
    return latest.select(
        "pipeline_run_id",
        "extract_batch_id",
        "run_type",
        "pipeline_status",
        "batch_status",
        "pages_downloaded",
        "record_count",
        "pipeline_started_at",
        "pipeline_finished_at",
        "watermark_value",
        "is_last_successful_run",
    )


def _decisions(spark, sf_dir):
    return control.watermark_decisions(
        given.finish_requests(spark, sf_dir),
        given.runs(spark, sf_dir),
        given.watermarks(spark, sf_dir),
    )


@query
def watermark_decision(spark, sf_dir):
    return _decisions(spark, sf_dir)


@query
def watermark_advance(spark, sf_dir):
    return control.advanced_watermarks(
        given.watermarks(spark, sf_dir), _decisions(spark, sf_dir), _moment(NOW)
    )


def _failure_decisions(spark, sf_dir):
    requests = given.finish_requests(spark, sf_dir).select("pipeline_run_id")
    return control.failure_decisions(
        requests.distinct().withColumns(
            {
                "failure_category": F.lit(V.UNKNOWN_ERROR),
                "error_message": F.lit("requested"),
            }
        ),
        given.runs(spark, sf_dir),
    )


@query
def failure_decision(spark, sf_dir):
    return _failure_decisions(spark, sf_dir)


@query
def run_closing(spark, sf_dir):
    """Runs after the failure requests; those without one stay as they were."""
    return control.closed_runs(
        given.runs(spark, sf_dir), _failure_decisions(spark, sf_dir), _moment(NOW)
    )


@query
def run_closing_events(spark, sf_dir):
    """The same closing as events on the runs it concerns; appended twice, once seen."""
    runs = EventTable(
        spark,
        given.fresh_path(spark, "runs"),
        schemas.PIPELINE_RUN,
        ["pipeline_run_id"],
    )
    runs.append(given.runs(spark, sf_dir), "opened")
    decisions = _failure_decisions(spark, sf_dir)
    marked = decisions.filter(F.col("decision") == control.MARK_FAILED)
    for _ in range(2):
        known = runs.read(marked)
        runs.append(control.closed_runs(known, marked, _moment(NOW)), "closed")
    return runs.read()


@query
def watermark_seed(spark, sf_dir):
    """Watermarks of the batch datasets from the latest line item of each."""
    return control.seed_watermark(
        given.watermarks(spark, sf_dir),
        given.table(spark, sf_dir, "lineitem"),
        dataset=F.concat(F.lit("ds-"), (F.col("l_suppkey") + 5).cast("string")),
        run_id=F.lit("run-1"),
        updated_at=F.col("l_shipdate").cast("timestamp"),
        watermark_column="updated_at",
        now=_moment(NOW),
    )


# Dashboard


@query
def complete_months(spark, sf_dir):
    return charts.complete_months(given.trends(spark, sf_dir), AS_OF)


@query
def dashboard_filters(spark, sf_dir):
    return charts.dashboard_filters(
        given.trends(spark, sf_dir),
        since=datetime(1997, 2, 1, 15, 2, 42),
        until=datetime(2000, 5, 1, 15, 2, 42),
        types=["1-URGENT/1", "5-LOW/3", "2-HIGH/0"],
    )


@query
def metric_totals(spark, sf_dir):
    mart = given.trends(spark, sf_dir)
    return charts.headline(mart, "total_incidents", "cleared_incidents")


@query
def metric_clearance_rate(spark, sf_dir):
    return charts.headline(given.trends(spark, sf_dir), "clearance_rate")


@query
def metric_fv_rate(spark, sf_dir):
    return charts.headline(given.trends(spark, sf_dir), "family_violence_rate")


@query
def district_share(spark, sf_dir):
    return charts.district_share(given.trends(spark, sf_dir), AS_OF)


@query
def monthly_series(spark, sf_dir):
    return charts.monthly_series(given.trends(spark, sf_dir), AS_OF)


@query
def monthly_series_range(spark, sf_dir):
    return charts.monthly_series(
        given.trends(spark, sf_dir),
        since=datetime(1996, 8, 1, 15, 2, 42),
        until=datetime(2001, 8, 1, 15, 2, 42),
    )


@query
def top_types(spark, sf_dir):
    return charts.top_types(given.trends(spark, sf_dir), AS_OF)


@query
def incidents_by_district(spark, sf_dir):
    return charts.incidents_by_district(given.trends(spark, sf_dir), AS_OF)


# Registered under the operator's own name, which is imported above.
QUERIES["partition_stats"] = QUERIES.pop("partition_stats_by_year")
