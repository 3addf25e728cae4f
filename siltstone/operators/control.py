"""Load-mode gate, manifest gates, run ledger and watermark decisions.

All of them are set operations: any number of datasets, batches or requests is
decided in one query.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.measures import seconds_between
from siltstone.functions.predicates import holds
from siltstone.operators.merge import upsert
from siltstone.operators.skew import heavy_keys, is_heavy, lookup

REJECTED = "REJECTED"
ADVANCE = "ADVANCE"
ALREADY_FINALIZED = "ALREADY_FINALIZED"
MARK_FAILED = "MARK_FAILED"
ALREADY_FAILED = "ALREADY_FAILED"

#: For the few rows of single requests and reports, which need no measuring.
NONE_HEAVY: dict[str, list] = {"pipeline_run_id": [], "dataset_id": []}


def choose_load_mode(changed: int, total: int) -> str:
    """Load mode of one change window; counts that cannot be are an error."""
    if changed < 0 or total < 0:
        raise ValueError("Record counts cannot be negative.")
    if changed > total:
        raise ValueError("More records changed than the source holds.")
    if changed == 0:
        return V.NO_CHANGES
    if changed == total:
        return V.FULL_SNAPSHOT
    if changed / total >= V.BULK_REVIEW_THRESHOLD:
        return V.REVIEW_REQUIRED
    return V.INCREMENTAL


def load_mode_of(changed: Column, total: Column) -> Column:
    """The same decision as a column, REJECTED where the function raises."""
    impossible = (changed < 0) | (total < 0) | (changed > total)
    return (
        F.when(changed.isNull() | total.isNull() | impossible, REJECTED)
        .when(changed == 0, V.NO_CHANGES)
        .when(changed == total, V.FULL_SNAPSHOT)
        .when(changed / total >= V.BULK_REVIEW_THRESHOLD, V.REVIEW_REQUIRED)
        .otherwise(V.INCREMENTAL)
    )


def load_modes(
    source: DataFrame, watermarks: DataFrame, dataset: str, updated_at: str
) -> DataFrame:
    """Change window and load mode per dataset.

    ``watermarks`` holds ``watermark_value`` per dataset. A dataset without one is
    REJECTED rather than loaded.
    """
    known = watermarks.select(dataset, "watermark_value")
    changed = F.col(updated_at) > F.col("watermark_value")
    windows = (
        lookup(source.select(dataset, updated_at), known, dataset)
        .groupBy(dataset)
        .agg(
            F.count(F.lit(1)).alias("source_record_count"),
            F.count_if(changed).alias("_changed"),
            F.max(F.when(changed, F.col(updated_at))).alias("window_end"),
        )
    )
    # One row per dataset on both sides; a dataset may have no source rows.
    windows = windows.join(known, dataset, "full_outer")
    total = F.coalesce("source_record_count", F.lit(0))
    found = F.coalesce("_changed", F.lit(0))
    count = F.when(F.col("watermark_value").isNotNull(), found)
    return windows.select(
        dataset,
        total.alias("source_record_count"),
        count.alias("changed_record_count"),
        "window_end",
        load_mode_of(count, total).alias("load_mode"),
    )


def review_message(changed: Column, total: Column) -> Column:
    return F.format_string(
        "Bulk change at or above the review threshold, not a complete snapshot: "
        "changed=%d, source=%d, percentage=%.2f%%",
        changed,
        total,
        changed * 100 / total,
    )


def run_outcomes(modes: DataFrame) -> DataFrame:
    """Ledger entries of the windows that are not extracted.

    No changes is a success, a bulk change under review a failure with a blocked
    batch; both have no pages and no records.
    """
    blocked = F.col("load_mode") == V.REVIEW_REQUIRED
    message = review_message(F.col("changed_record_count"), F.col("source_record_count"))
    return modes.filter(
        F.col("load_mode").isin(V.NO_CHANGES, V.REVIEW_REQUIRED)
    ).withColumns(
        {
            "run_type": F.col("load_mode"),
            "pipeline_status": F.when(blocked, V.FAILED).otherwise(V.SUCCESS),
            "batch_status": F.when(blocked, V.BLOCKED).otherwise(V.SUCCESS),
            "failure_category": F.when(blocked, V.BULK_CHANGE_REVIEW),
            "error_message": F.when(blocked, message),
            "pages_downloaded": F.lit(0),
            "record_count": F.lit(0).cast("long"),
        }
    )


def manifest_gate(
    manifests: DataFrame, batch_counts: DataFrame, run_id: str = "run_id"
) -> DataFrame:
    """Verdict per batch: a SUCCESS manifest whose counts match what was read.

    ``batch_counts`` holds ``actual_record_count`` per run; a manifest without one
    counts as a batch of no records.
    """
    expected, extracted, actual = (
        F.col(f"{name}_record_count") for name in ("expected", "extracted", "actual")
    )
    counts_match = holds((expected == extracted) & (extracted == actual))
    return (
        batch_counts.join(
            manifests.select(
                run_id,
                "status",
                "expected_record_count",
                "extracted_record_count",
                F.lit(True).alias("_found"),
            ),
            run_id,
            "full_outer",
        )
        .withColumn("actual_record_count", F.coalesce(actual, F.lit(0)))
        .withColumn(
            "verdict",
            F.when(F.col("_found").isNull(), "MANIFEST_MISSING")
            .when(~holds(F.col("status") == V.SUCCESS), "NOT_SUCCESSFUL")
            .when(~counts_match, V.COUNT_MISMATCH)
            .otherwise("ACCEPTED"),
        )
        .drop("_found")
    )


def manifest_totals(entries: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Files, distinct file names and records that each manifest lists."""
    return entries.groupBy(run_id).agg(
        F.count(F.lit(1)).alias("listed_files"),
        F.count_distinct("file_name").alias("distinct_files"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("listed_records"),
    )


def manifest_files(
    entries: DataFrame, inventory: DataFrame, run_id: str = "run_id"
) -> DataFrame:
    """Listed and stored page files side by side, with what is wrong with each."""
    listed = (
        entries.groupBy(run_id, "file_name")
        .agg(
            F.count(F.lit(1)).alias("times_listed"),
            F.max("record_count").alias("listed_record_count"),
            F.max("file_size_bytes").alias("listed_size_bytes"),
        )
    )
    stored = inventory.select(
        run_id,
        "file_name",
        F.col("record_count").alias("stored_record_count"),
        F.col("file_size_bytes").alias("stored_size_bytes"),
    )
    problem = (
        F.when(F.col("times_listed") > 1, "LISTED_TWICE")
        .when(F.col("stored_record_count").isNull(), "NOT_STORED")
        .when(F.col("times_listed").isNull(), "NOT_LISTED")
        .when(
            ~F.col("listed_size_bytes").eqNullSafe(F.col("stored_size_bytes")),
            "SIZE_DIFFERS",
        )
        .when(
            ~F.col("listed_record_count").eqNullSafe(F.col("stored_record_count")),
            "RECORDS_DIFFER",
        )
    )
    return listed.join(stored, [run_id, "file_name"], "full_outer").withColumn(
        "problem", problem
    )


def changed_files(ledger: DataFrame, stored: DataFrame) -> DataFrame:
    """Registered files whose bytes are not those on storage, and unregistered ones.

    Both sides hold ``file_name``, ``file_size_bytes`` and ``checksum_sha256`` of one
    batch. Content of equal size counts as changed when its digest differs; a file
    registered without a digest is compared by size.
    """
    known = ledger.select(
        "file_name",
        F.col("file_size_bytes").alias("registered_size_bytes"),
        F.col("checksum_sha256").alias("registered_checksum"),
        F.lit(True).alias("_known"),
    )
    size = F.col("file_size_bytes").eqNullSafe(F.col("registered_size_bytes"))
    digest = F.col("registered_checksum").isNull() | F.col(
        "registered_checksum"
    ).eqNullSafe(F.col("checksum_sha256"))
    problem = (
        F.when(F.col("_known").isNull(), "NOT_REGISTERED")
        .when(F.col("checksum_sha256").isNull(), "NOT_STORED")
        .when(~size, "SIZE_DIFFERS")
        .when(~digest, "CONTENT_DIFFERS")
    )
    found = stored.select("file_name", "file_size_bytes", "checksum_sha256")
    return (
        known.join(found, "file_name", "full_outer")
        .withColumn("problem", problem)
        .filter("problem IS NOT NULL")
        .drop("_known")
    )


def manifest_checks(
    manifests: DataFrame,
    entries: DataFrame,
    inventory: DataFrame,
    run_id: str = "run_id",
) -> DataFrame:
    """One row per manifest: whether its files, pages and totals hold."""
    files = (
        manifest_files(entries, inventory, run_id)
        .groupBy(run_id)
        .agg(F.count("problem").alias("file_problems"))
    )
    stated = manifests.select(
        run_id, "status", "pages_downloaded", "extracted_record_count"
    )
    checked = stated.join(manifest_totals(entries, run_id), run_id, "left").join(
        files, run_id, "left"
    )
    counts = ["listed_files", "distinct_files", "listed_records", "file_problems"]
    return checked.na.fill(0, counts).withColumns(
        {
            "names_unique": F.col("listed_files") == F.col("distinct_files"),
            "pages_match": holds(F.col("listed_files") == F.col("pages_downloaded")),
            "records_match": holds(
                F.col("listed_records") == F.col("extracted_record_count")
            ),
        }
    ).withColumn(
        "accepted",
        holds(F.col("status") == V.SUCCESS)
        & F.col("names_unique")
        & F.col("pages_match")
        & F.col("records_match")
        & (F.col("file_problems") == 0),
    )


def register_files(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """File ledger after registering pages; a known object takes the new counts."""
    return upsert(
        ledger,
        files,
        ["extract_batch_id", "object_path"],
        updated_at=None,
        set_columns=["record_count", "file_size_bytes"],
    )


def run_summary(
    runs: DataFrame,
    batches: DataFrame,
    watermarks: DataFrame,
    now: Column | None = None,
    heavy: dict[str, list] | None = None,
) -> DataFrame:
    """Runs with their batches and the watermark of the batch's dataset.

    An outer join cannot split its batch side if one run holds very many of the
    batches. Such runs are measured beforehand; their few rows are broadcast to the
    batches, and all others take the outer join, which reads and shuffles each side
    once.
    """
    end = F.coalesce("finished_at", F.current_timestamp() if now is None else now)
    run_columns = runs.select(
        "pipeline_run_id",
        "pipeline_name",
        "run_type",
        F.col("status").alias("pipeline_status"),
        F.col("started_at").alias("pipeline_started_at"),
        F.col("finished_at").alias("pipeline_finished_at"),
        seconds_between(F.col("started_at"), end).alias("pipeline_duration_seconds"),
        "failure_category",
        "error_message",
        "created_at",
    )
    batch_columns = batches.select(
        "pipeline_run_id",
        "extract_batch_id",
        "dataset_id",
        F.col("status").alias("batch_status"),
        "page_size",
        "pages_downloaded",
        "record_count",
        "raw_prefix",
        "manifest_path",
        F.col("started_at").alias("batch_started_at"),
        F.col("finished_at").alias("batch_finished_at"),
    )
    marks = watermarks.select(
        "dataset_id",
        "watermark_column",
        "watermark_value",
        "last_successful_pipeline_run_id",
    )
    if heavy is None:
        heavy = heavy_keys(batches, "pipeline_run_id", "dataset_id")
    hot_runs = [run for run in heavy["pipeline_run_id"] if run is not None]
    hot = is_heavy("pipeline_run_id", hot_runs)
    with_batch = run_columns.filter(~hot).join(
        batch_columns.filter(~hot), "pipeline_run_id", "left"
    )
    if hot_runs:
        # One row a run: at most as many as there can be heavy ones. Each has batches.
        few = F.broadcast(run_columns.filter(hot))
        with_batch = with_batch.unionByName(
            batch_columns.filter(hot)
            .join(few, "pipeline_run_id")
            .select(with_batch.columns)
        )
    last = F.col("last_successful_pipeline_run_id") == F.col("pipeline_run_id")
    # Runs without a batch have a NULL dataset, like many rows of one key.
    datasets = [*heavy["dataset_id"], None] if heavy["dataset_id"] else []
    return lookup(with_batch, marks, "dataset_id", datasets).withColumn(
        "is_last_successful_run", holds(last)
    )


def latest_runs(
    runs: DataFrame,
    batches: DataFrame,
    watermarks: DataFrame,
    now: Column | None = None,
    rows: int = V.PROFILE_ROWS,
) -> DataFrame:
    """The first rows of the run summary: runs not started, then newest first.

    Every run has at least one row, so the newest runs are picked before the join
    and only their batches, found by their few ids, take part in it.
    """
    newest = runs.orderBy(F.desc_nulls_first("started_at"), "pipeline_run_id").limit(rows)
    wanted = F.broadcast(newest.select("pipeline_run_id"))
    theirs = batches.join(wanted, "pipeline_run_id", "left_semi")
    return (
        run_summary(newest, theirs, watermarks, now, NONE_HEAVY)
        .orderBy(
            F.desc_nulls_first("pipeline_started_at"),
            "pipeline_run_id",
            "extract_batch_id",
        )
        .limit(rows)
    )


def watermark_decisions(
    requests: DataFrame,
    runs: DataFrame,
    watermarks: DataFrame,
    heavy: dict[str, list] | None = None,
) -> DataFrame:
    """What to do with each request to finish a run and advance its watermark.

    Requests hold ``pipeline_run_id``, ``dataset_id`` and ``window_end``. The
    checks apply in order; the first that fails gives the reason.
    """
    run_state = runs.select(
        "pipeline_run_id",
        F.col("status").alias("run_status"),
        F.lit(True).alias("_run"),
    )
    mark_state = watermarks.select(
        "dataset_id",
        F.col("watermark_value").alias("current_watermark"),
        "last_successful_pipeline_run_id",
        F.lit(True).alias("_mark"),
    )
    if heavy is None:
        heavy = heavy_keys(requests, "pipeline_run_id", "dataset_id")
    current, end = F.col("current_watermark"), F.col("window_end")
    finished = holds(
        (F.col("run_status") == V.SUCCESS)
        & (F.col("last_successful_pipeline_run_id") == F.col("pipeline_run_id"))
        & (current >= end)
    )
    decision = (
        F.when(F.col("_run").isNull(), "RUN_NOT_FOUND")
        .when(F.col("_mark").isNull(), "WATERMARK_NOT_FOUND")
        .when(finished, ALREADY_FINALIZED)
        .when(~holds(F.col("run_status") == V.RUNNING), "RUN_NOT_RUNNING")
        .when(holds(end < current), "WATERMARK_WOULD_GO_BACK")
        .otherwise(ADVANCE)
    )
    return (
        lookup(
            lookup(requests, run_state, "pipeline_run_id", heavy["pipeline_run_id"]),
            mark_state,
            "dataset_id",
            heavy["dataset_id"],
        ).select(
            "pipeline_run_id",
            "dataset_id",
            "window_end",
            "run_status",
            "current_watermark",
            decision.alias("decision"),
            F.when(decision == ADVANCE, end)
            .when(decision == ALREADY_FINALIZED, current)
            .alias("new_watermark"),
        )
    )


def failure_decisions(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """What to do with each request to mark a run as failed."""
    state = runs.select(
        "pipeline_run_id",
        F.col("status").alias("run_status"),
        F.lit(True).alias("_run"),
    )
    decision = (
        F.when(F.col("_run").isNull(), "RUN_NOT_FOUND")
        .when(F.col("run_status") == V.RUNNING, MARK_FAILED)
        .when(F.col("run_status") == V.FAILED, ALREADY_FAILED)
        .otherwise("NOT_FAILABLE")
    )
    return (
        requests.join(state, "pipeline_run_id", "left")
        .withColumn("decision", decision)
        .drop("_run")
    )


def advanced_watermarks(
    watermarks: DataFrame, decisions: DataFrame, now: Column | None = None
) -> DataFrame:
    """Watermarks after the accepted requests, the latest end winning."""
    latest = (
        decisions.filter(F.col("decision") == ADVANCE)
        .groupBy("dataset_id")
        .agg(
            F.max(F.struct("window_end", "pipeline_run_id")).alias("_won"),
        )
        .select(
            "dataset_id",
            F.lit(None).cast("string").alias("watermark_column"),
            F.col("_won.window_end").alias("watermark_value"),
            F.col("_won.pipeline_run_id").alias("last_successful_pipeline_run_id"),
            (F.current_timestamp() if now is None else now).alias("updated_at"),
        )
    )
    return upsert(
        watermarks,
        latest,
        "dataset_id",
        updated_at=None,
        set_columns=["watermark_value", "last_successful_pipeline_run_id", "updated_at"],
    )


def closed_runs(
    runs: DataFrame, decisions: DataFrame, now: Column | None = None
) -> DataFrame:
    """Runs after success or failure decisions.

    A run that was advanced becomes SUCCESS without failure fields, one that was
    marked becomes FAILED with those of the request.
    """
    fields = {"failure_category", "error_message"} & set(decisions.columns)
    wanted = decisions.filter(F.col("decision").isin(ADVANCE, MARK_FAILED)).select(
        "pipeline_run_id",
        F.when(F.col("decision") == ADVANCE, V.SUCCESS)
        .otherwise(V.FAILED)
        .alias("status"),
        (F.current_timestamp() if now is None else now).alias("finished_at"),
        *[
            (F.col(name) if name in fields else F.lit(None).cast("string")).alias(name)
            for name in ("failure_category", "error_message")
        ],
    )
    one_each = wanted.dropDuplicates(["pipeline_run_id"])
    replaced = ["status", "finished_at", "failure_category", "error_message"]
    rest = [c for c in runs.columns if c not in one_each.columns]
    padded = one_each.select(
        "*", *[F.lit(None).cast(runs.schema[c].dataType).alias(c) for c in rest]
    )
    return upsert(runs, padded, "pipeline_run_id", updated_at=None, set_columns=replaced)


def seed_watermark(
    watermarks: DataFrame,
    base: DataFrame,
    *,
    dataset: Column,
    run_id: Column,
    updated_at: Column,
    watermark_column: str,
    now: Column | None = None,
) -> DataFrame:
    """Watermarks after setting each dataset to the latest update in the base."""
    latest = base.groupBy(dataset.alias("dataset_id")).agg(
        F.lit(watermark_column).alias("watermark_column"),
        F.max(updated_at).alias("watermark_value"),
        F.max(run_id).alias("last_successful_pipeline_run_id"),
    )
    stamped = latest.withColumn(
        "updated_at", F.current_timestamp() if now is None else now
    )
    return upsert(
        watermarks,
        stamped,
        "dataset_id",
        updated_at=None,
        set_columns=["watermark_value", "last_successful_pipeline_run_id", "updated_at"],
    )
