"""Extraction, run ledger and the daily load around the layers."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone import values as V
from siltstone.functions.parsing import instant_of
from siltstone.operators import control, merge
from siltstone.operators.quality import require_empty
from siltstone.plans import layers
from siltstone.plans.lake import Lake, one_row
from siltstone.sources import changes, landing

PIPELINE_NAME = "incident_load"
PROCESSING_FAILURE = "PROCESSING_FAILURE"
SOURCE_TIME = ":updated_at"
SOURCE_ORDER = [":updated_at", ":id"]


class ReviewRequired(RuntimeError):
    """A bulk change that is not a complete snapshot waits for a person."""


class ExtractionIncomplete(RuntimeError):
    """The landed records are not the expected ones."""


def _utc_text(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).isoformat()


def _open_run(lake: Lake, load_mode: str, dataset_id: str, prefix: str) -> dict:
    ids = {"pipeline_run_id": str(uuid.uuid4()), "extract_batch_id": str(uuid.uuid4())}
    now = datetime.now(timezone.utc)
    _record(
        lake,
        ids,
        run={"run_type": load_mode, "status": V.RUNNING, "started_at": now},
        batch={
            "dataset_id": dataset_id,
            "status": V.RUNNING,
            "raw_prefix": prefix,
            "started_at": now,
        },
    )
    return ids


def _record(lake: Lake, ids: dict, run: dict, batch: dict) -> None:
    now = datetime.now(timezone.utc)
    run_row = one_row(
        lake.spark,
        schemas.PIPELINE_RUN,
        pipeline_run_id=ids["pipeline_run_id"],
        pipeline_name=PIPELINE_NAME,
        created_at=now,
        **run,
    )
    batch_row = one_row(
        lake.spark,
        schemas.EXTRACT_BATCH,
        **ids,
        source_url="source table",
        page_size=V.PAGE_SIZE,
        created_at=now,
        **{"pages_downloaded": 0, "record_count": 0, **batch},
    )
    lake.runs.append(run_row, f"opened {ids['pipeline_run_id']}")
    lake.batches.append(batch_row, f"opened {ids['extract_batch_id']}")


def _close_batch(lake: Lake, batch_id: str, **fields) -> None:
    row = one_row(
        lake.spark,
        schemas.EXTRACT_BATCH,
        extract_batch_id=batch_id,
        finished_at=datetime.now(timezone.utc),
        **fields,
    )
    known = lake.control_batches().filter(F.col("extract_batch_id") == batch_id)
    closed = merge.upsert(
        known,
        row,
        "extract_batch_id",
        updated_at=None,
        set_columns=["finished_at", *fields],
    )
    lake.batches.append(closed, f"closed {batch_id}")


def extract_changes(
    lake: Lake, source: DataFrame, *, dataset_id: str, landing_root: str, run_id: str
) -> dict:
    """Land the change window of a source table as pages and a manifest.

    Decides the load mode first: no changes lands nothing, a suspicious bulk
    change is recorded and refused.
    """
    marks = lake.control_watermarks().filter(F.col("dataset_id") == dataset_id)
    known = marks.first()
    if known is None or known["watermark_value"] is None:
        raise ValueError(f"No watermark found for {dataset_id}.")
    mark = known["watermark_value"]
    changed = changes.change_window(source, mark, SOURCE_TIME)
    counts = changed.select("record_count", _instant("max_updated_at")).first()
    window = {
        "source_record_count": source.count(),
        "changed_record_count": counts["record_count"],
        "window_end": _with_zone(counts["max_updated_at"]),
    }
    mode = control.choose_load_mode(
        window["changed_record_count"], window["source_record_count"]
    )
    if mode in (V.NO_CHANGES, V.REVIEW_REQUIRED):
        decided = {k: F.lit(v) for k, v in window.items()} | {"load_mode": F.lit(mode)}
        return _record_outcome(lake, lake.spark.range(1).withColumns(decided), dataset_id)
    prefix = landing.batch_path(landing_root, run_id)
    ids = _open_run(lake, mode, dataset_id, prefix)
    manifest = _land_batch(
        lake,
        changes.window_rows(source, mark, window["window_end"], SOURCE_TIME),
        prefix,
        expected=window["changed_record_count"],
        source_records=window["source_record_count"],
        run={
            **ids,
            "run_id": run_id,
            "run_type": mode,
            "load_mode": mode,
            "dataset_id": dataset_id,
            "watermark_start": _utc_text(mark),
            "window_end": _utc_text(window["window_end"]),
        },
    )
    return {
        **ids,
        "has_changes": True,
        "run_id": run_id,
        "prefix": prefix,
        "record_count": manifest["extracted_record_count"],
        "window_end": window["window_end"],
        "load_mode": mode,
        "status": V.SUCCESS,
    }


def _with_zone(moment: datetime | None) -> datetime | None:
    """Spark hands out instants without a zone, in the zone of this process."""
    return None if moment is None else moment.astimezone(timezone.utc)


def _instant(name: str):
    return F.col(name).cast("timestamp").alias(name)


def _record_outcome(lake: Lake, modes: DataFrame, dataset_id: str) -> dict:
    outcome = control.run_outcomes(modes).first()
    ids = {"pipeline_run_id": str(uuid.uuid4()), "extract_batch_id": str(uuid.uuid4())}
    now = datetime.now(timezone.utc)
    times = {"started_at": now, "finished_at": now}
    _record(
        lake,
        ids,
        run={
            "run_type": outcome["run_type"],
            "status": outcome["pipeline_status"],
            "failure_category": outcome["failure_category"],
            "error_message": outcome["error_message"],
            **times,
        },
        batch={"dataset_id": dataset_id, "status": outcome["batch_status"], **times},
    )
    if outcome["load_mode"] == V.REVIEW_REQUIRED:
        raise ReviewRequired(outcome["error_message"])
    return {
        **ids,
        "has_changes": False,
        "run_id": None,
        "record_count": 0,
        "window_end": None,
        "load_mode": V.NO_CHANGES,
        "status": V.SUCCESS,
    }


def _land_batch(
    lake: Lake,
    rows: DataFrame,
    prefix: str,
    *,
    run: dict,
    expected: int,
    source_records: int,
) -> Row:
    """Land rows as pages and manifest, register the pages, and close the batch.

    A batch that is not complete fails its run before anything reads it.
    """
    try:
        landing.write_pages(rows, prefix, SOURCE_ORDER)
        landing.write_manifest(
            lake.spark,
            prefix,
            run=run,
            expected=expected,
            source_records=source_records,
        )
        digests = _page_checksums(lake, prefix).select("file_name", "checksum_sha256")
        listed = landing.scan_entries(lake.spark, prefix)
        entries = listed.join(digests, "file_name", "left").select(
            F.lit(run["extract_batch_id"]).alias("extract_batch_id"),
            "file_name",
            F.concat(F.lit(prefix), "file_name").alias("object_path"),
            "record_count",
            "file_size_bytes",
            "checksum_sha256",
            F.current_timestamp().alias("created_at"),
        )
        known = lake.files.read(entries)
        lake.files.append(
            control.register_files(known, entries), f"pages {run['extract_batch_id']}"
        )
        landed = landing.scan_manifest(lake.spark, prefix).drop("files").first()
    except Exception as error:
        _close_batch(lake, run["extract_batch_id"], status=V.FAILED)
        mark_failed(lake, run["pipeline_run_id"], V.UNKNOWN_ERROR, str(error))
        raise
    _close_batch(
        lake,
        run["extract_batch_id"],
        status=landed["status"],
        pages_downloaded=landed["pages_downloaded"],
        record_count=landed["extracted_record_count"],
        manifest_path=f"{prefix}{landing.MANIFEST_FOLDER}",
    )
    if landed["status"] != V.SUCCESS:
        message = f"Extraction finished with status {landed['status']}."
        mark_failed(lake, run["pipeline_run_id"], V.DATA_QUALITY_FAILURE, message)
        raise ExtractionIncomplete(message)
    return landed


def _page_checksums(lake: Lake, prefix: str) -> DataFrame:
    return landing.page_checksums(
        lake.spark, f"{prefix.rstrip('/')}/{landing.PAGES_GLOB}"
    )


def check_landed_pages(lake: Lake, batch_id: str, prefix: str) -> None:
    """The bytes on storage are those that were registered when the batch was landed."""
    registered = lake.control_files().filter(F.col("extract_batch_id") == batch_id)
    require_empty(
        control.changed_files(registered, _page_checksums(lake, prefix)),
        "Landed pages are not those registered.",
    )


def finish_run(lake: Lake, run_id: str, dataset_id: str, window_end: datetime) -> dict:
    """Advance the watermark and close the run; a repeated call changes nothing."""
    if not run_id or window_end is None:
        raise ValueError("A run id and a window end are required.")
    uuid.UUID(run_id)
    if window_end.tzinfo is None:
        raise ValueError("The window end needs a time zone.")
    request = lake.spark.range(1).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(window_end).cast("timestamp").alias("window_end"),
    )
    marks = lake.control_watermarks().filter(F.col("dataset_id") == dataset_id)
    runs = lake.control_runs().filter(F.col("pipeline_run_id") == run_id)
    decisions = control.watermark_decisions(request, runs, marks, control.NONE_HEAVY)
    decided = decisions.first()
    decision = decided["decision"]
    if decision == control.ADVANCE:
        # The watermark first: repeating the call after a failure in between
        # advances to the same value and then closes the run.
        event = f"finished {run_id}"
        lake.watermarks.append(control.advanced_watermarks(marks, decisions), event)
        lake.runs.append(control.closed_runs(runs, decisions), event)
    elif decision != control.ALREADY_FINALIZED:
        raise ValueError(f"Run {run_id} cannot be finished: {decision}.")
    return {
        "pipeline_run_id": run_id,
        "status": V.SUCCESS,
        "watermark_value": decided["new_watermark"],
        "already_finalized": decision == control.ALREADY_FINALIZED,
    }


def mark_failed(lake: Lake, run_id: str, category: str, message: str) -> dict:
    """Close a running run as failed."""
    if not (run_id and category and message):
        raise ValueError("A run id, a failure category and a message are required.")
    request = lake.spark.range(1).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(category).alias("failure_category"),
        F.lit(message).alias("error_message"),
    )
    runs = lake.control_runs().filter(F.col("pipeline_run_id") == run_id)
    decisions = control.failure_decisions(request, runs)
    decision = decisions.first()["decision"]
    if decision == control.MARK_FAILED:
        lake.runs.append(control.closed_runs(runs, decisions), f"failed {run_id}")
    elif decision != control.ALREADY_FAILED:
        raise ValueError(f"Run {run_id} cannot be marked as failed: {decision}.")
    return {
        "pipeline_run_id": run_id,
        "status": V.FAILED,
        "already_finalized": decision == control.ALREADY_FAILED,
    }


def _build_and_validate(lake: Lake, report: layers.LoadReport) -> None:
    if lake.in_parts:
        layers.refresh(lake, report.changes)
    else:
        layers.build_silver(lake)
        layers.build_gold(lake)
        layers.build_models(lake)
    layers.check_models(lake)
    layers.validate_layers(lake)


def daily_load(
    lake: Lake, source: DataFrame, *, dataset_id: str, landing_root: str, run_id: str
) -> dict:
    """One scheduled run, from change window to advanced watermark.

    The watermark moves last, after every gate passed, so a failed run is replayed
    by the next one.
    """
    batch = extract_changes(
        lake, source, dataset_id=dataset_id, landing_root=landing_root, run_id=run_id
    )
    if not batch["has_changes"]:
        return batch
    try:
        check_landed_pages(lake, batch["extract_batch_id"], batch["prefix"])
        report = layers.load_base(
            lake,
            batch["prefix"],
            run_id=run_id,
            dataset_id=dataset_id,
            full_snapshot=batch["load_mode"] == V.FULL_SNAPSHOT,
            json_lines=True,
        )
        _build_and_validate(lake, report)
    except Exception as error:
        mark_failed(lake, batch["pipeline_run_id"], PROCESSING_FAILURE, str(error))
        raise
    # Outside the handler: a run whose watermark has moved must not become FAILED.
    # Repeating finish_run after a failure in here closes it.
    finished = finish_run(
        lake,
        batch["pipeline_run_id"],
        dataset_id,
        batch["window_end"],
    )
    lake.publish(only_named=True)
    return {**batch, **finished, "load": report}


def bootstrap(
    lake: Lake, source: DataFrame, *, dataset_id: str, landing_root: str, run_id: str
) -> dict:
    """The first full snapshot, all layers, and the first watermark."""
    prefix = landing.batch_path(landing_root, run_id)
    ids = _open_run(lake, V.FULL_SNAPSHOT, dataset_id, prefix)
    expected = source.count()
    _land_batch(
        lake,
        source,
        prefix,
        run={
            **ids,
            "run_id": run_id,
            "run_type": V.FULL_SNAPSHOT,
            "load_mode": V.FULL_SNAPSHOT,
            "dataset_id": dataset_id,
        },
        expected=expected,
        source_records=expected,
    )
    try:
        check_landed_pages(lake, ids["extract_batch_id"], prefix)
        report = layers.load_base(
            lake,
            prefix,
            run_id=run_id,
            dataset_id=dataset_id,
            full_snapshot=True,
            json_lines=True,
        )
        _build_and_validate(lake, report)
    except Exception as error:
        mark_failed(lake, ids["pipeline_run_id"], PROCESSING_FAILURE, str(error))
        raise
    stored = lake.bronze.read()
    lake.watermarks.append(
        control.seed_watermark(
            lake.control_watermarks(),
            stored,
            dataset=F.col("dataset_id"),
            run_id=F.lit(ids["pipeline_run_id"]),
            updated_at=instant_of(stored, V.UPDATED_AT),
            watermark_column=SOURCE_TIME,
        ),
        f"seeded {ids['pipeline_run_id']}",
    )
    mark = lake.control_watermarks().filter(F.col("dataset_id") == dataset_id).first()
    finish_run(
        lake,
        ids["pipeline_run_id"],
        dataset_id,
        _with_zone(mark["watermark_value"]),
    )
    lake.publish(only_named=True)
    return {**ids, "run_id": run_id, "prefix": prefix, "load": report}


def recent_runs(lake: Lake, rows: int = V.PROFILE_ROWS) -> DataFrame:
    return control.latest_runs(
        lake.control_runs(),
        lake.control_batches(),
        lake.control_watermarks(),
        rows=rows,
    )

