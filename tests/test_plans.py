"""Whole jobs on small lakes."""

from datetime import datetime, timezone

import pytest
from compare import rows
from pyspark.sql import functions as F

from siltstone import jobs, schemas
from siltstone import values as V
from siltstone.operators.quality import QualityError
from siltstone.plans import layers, reconciliation, runs
from siltstone.plans.lake import Lake
from siltstone.registry.inputs import raw_incidents
from siltstone.sources import tables

DATASET = "incidents"


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return raw_incidents(spark, sf_dir)


@pytest.fixture(scope="module")
def lake(spark, source, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(spark, str(root / "tables"))
    lake.raw_root = str(root / "raw")
    loaded = runs.bootstrap(lake, source, **where(lake, "run-0"))
    assert loaded["load"].saved == source.count()
    return lake


def where(lake, run_id):
    return {"dataset_id": DATASET, "landing_root": lake.raw_root, "run_id": run_id}


def changed(source, share, day):
    """The source after a share of its rows changed on a later day."""
    hit = F.pmod(F.xxhash64(V.BUSINESS_KEY), F.lit(100)) < share
    moved = f"2026-08-{day:02d}T12:00:00.000Z"
    return source.withColumns(
        {
            ":updated_at": F.when(hit, moved).otherwise(F.col(":updated_at")),
            "sector": F.when(hit, "changed").otherwise(F.col("sector")),
        }
    )


def state(lake, run):
    row = lake.control_runs().filter(F.col("pipeline_run_id") == run).first()
    return row["status"], row["failure_category"]


def test_daily_life_of_a_lake(lake, source):
    total = source.count()

    quiet = runs.daily_load(lake, source, **where(lake, "run-1"))
    assert (quiet["has_changes"], quiet["load_mode"]) == (False, V.NO_CHANGES)
    assert state(lake, quiet["pipeline_run_id"]) == (V.SUCCESS, None)

    some = changed(source, 20, 1)
    loaded = runs.daily_load(lake, some, **where(lake, "run-2"))
    touched = some.filter("sector = 'changed'").count()
    assert loaded["load_mode"] == V.INCREMENTAL
    assert loaded["load"].merged == touched == loaded["record_count"]
    assert loaded["load"].saved == total
    assert lake.fact.read().filter("sector = 'changed'").count() == touched
    assert state(lake, loaded["pipeline_run_id"]) == (V.SUCCESS, None)
    mark = lake.control_watermarks().first()
    assert mark["last_successful_pipeline_run_id"] == loaded["pipeline_run_id"]
    assert lake.control_files().count() == lake.control_files().select(
        "object_path"
    ).distinct().count()

    moved = mark["watermark_value"].astimezone(timezone.utc)
    again = runs.finish_run(lake, loaded["pipeline_run_id"], DATASET, moved)
    assert again["already_finalized"]
    with pytest.raises(ValueError, match="time zone"):
        runs.finish_run(lake, loaded["pipeline_run_id"], DATASET, mark["watermark_value"])
    with pytest.raises(ValueError, match="UUID"):
        runs.finish_run(lake, "run", DATASET, moved)
    nothing = runs.daily_load(lake, source.limit(0), **where(lake, "run-empty"))
    assert nothing["load_mode"] == V.NO_CHANGES

    with pytest.raises(runs.ReviewRequired):
        runs.daily_load(lake, changed(source, 90, 2), **where(lake, "run-3"))
    blocked = lake.control_batches().filter(F.col("status") == V.BLOCKED)
    assert blocked.count() == 1

    everything = changed(source, 100, 3)
    replaced = runs.daily_load(lake, everything, **where(lake, "run-4"))
    assert replaced["load_mode"] == V.FULL_SNAPSHOT
    assert lake.silver.read().filter("sector = 'changed'").count() == total

    overview = runs.recent_runs(lake)
    assert overview.filter("is_last_successful_run").count() == 1
    assert overview.first()["pipeline_run_id"] == replaced["pipeline_run_id"]

    agreed = reconciliation.reconcile_source(lake, everything, **where(lake, "keys-1"))
    assert agreed["summaries_match"]
    late = everything.filter(F.col(":id") != "row-5")
    with pytest.raises(QualityError, match="missing from the source"):
        reconciliation.reconcile_source(lake, late, **where(lake, "keys-2"))


def test_tables_are_published_and_listed(lake):
    names = lake.publish()
    spark = lake.spark
    assert "marts.incident_fact" in names
    listed = tables.list_tables(spark, "marts").select("tableName")
    assert ("incident_fact",) in rows(listed)
    count = spark.sql("SELECT sum(incident_count) FROM gold.monthly_summary").first()[0]
    assert count == lake.bronze.latest()["record_count"]


def test_table_rename(spark):
    tables.ensure_namespace(spark, "scratch")
    spark.range(3).write.mode("overwrite").saveAsTable("scratch.before")
    tables.rename_table(spark, "scratch.before", "scratch.after")
    assert spark.catalog.tableExists("scratch.after")
    assert not spark.catalog.tableExists("scratch.before")
    spark.sql("DROP TABLE scratch.after")


def test_failed_gate_leaves_watermark_and_marks_run(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path / "tables"))
    lake.raw_root = str(tmp_path / "raw")
    source = raw_incidents(spark, sf_dir)
    broken = source.withColumn(
        ":id", F.when(F.col(":id") != "row-7", F.col(":id"))
    )
    with pytest.raises(QualityError, match="source row id"):
        runs.bootstrap(lake, broken, **where(lake, "run-0"))
    run = lake.control_runs().first()
    assert (run["status"], run["failure_category"]) == (
        V.FAILED,
        runs.PROCESSING_FAILURE,
    )
    assert not lake.watermarks.exists()
    with pytest.raises(ValueError, match="No watermark"):
        runs.extract_changes(lake, source, **where(lake, "run-1"))
    with pytest.raises(ValueError, match="RUN_NOT_FOUND"):
        unknown = "00000000-0000-0000-0000-000000000000"
        moment = datetime(2026, 1, 1, tzinfo=timezone.utc)
        runs.finish_run(lake, unknown, DATASET, moment)
    failed_again = runs.mark_failed(lake, run["pipeline_run_id"], "X", "again")
    assert failed_again["already_finalized"]


def test_incomplete_extraction_fails_its_run(spark, source, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "tables"))
    lake.raw_root = str(tmp_path / "raw")
    write = runs.landing.write_pages
    monkeypatch.setattr(
        runs.landing,
        "write_pages",
        lambda rows, *rest: write(rows.filter(F.col(":id") != "row-7"), *rest),
    )
    with pytest.raises(runs.ExtractionIncomplete, match="COUNT_MISMATCH"):
        runs.bootstrap(lake, source, **where(lake, "run-0"))
    assert state(lake, lake.control_runs().first()["pipeline_run_id"]) == (
        V.FAILED,
        V.DATA_QUALITY_FAILURE,
    )
    batch = lake.control_batches().first()
    assert batch["status"] == V.COUNT_MISMATCH
    assert batch["record_count"] == source.count() - 1
    assert not lake.bronze.exists()


def test_layers_that_disagree_are_refused(lake):
    lake_copy = Lake(lake.spark, lake.root)
    tampered = lake.summary.read().withColumn(
        "incident_count", F.col("incident_count") + 1
    )
    lake_copy.summary.replace(tampered)
    with pytest.raises(QualityError, match="totals differ"):
        layers.validate_layers(lake_copy)
    layers.build_gold(lake_copy)
    layers.validate_layers(lake_copy)


def test_command_line(lake, monkeypatch, capsys):
    monkeypatch.setattr(lake.spark, "stop", lambda: None)
    monkeypatch.setattr(jobs, "build_session", lambda: lake.spark)
    root = ["--lake-root", lake.root, "--raw-root", lake.raw_root]
    for job in ("silver", "gold", "models", "validate", "inspect", "history"):
        jobs.main([*root, job])
    jobs.main([*root, "inspect-raw", "run-2", "--json-lines"])
    jobs.main([*root, "bronze", "run-2", "--json-lines"])
    assert "Records requiring merge: 0" in capsys.readouterr().out


def test_landed_schema_is_declared(lake):
    found = {f.name: f.dataType for f in lake.bronze.read().schema}
    assert found == {f.name: f.dataType for f in schemas.BASE_INCIDENT}
