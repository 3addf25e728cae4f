from datetime import datetime

import pytest
from compare import rows
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import control, quality, reconcile
from siltstone.operators.quality import QualityError
from siltstone.sources.landing import nested_entries

CASES = [
    (0, 100, "NO_CHANGES"),
    (0, 0, "NO_CHANGES"),
    (100, 100, "FULL_SNAPSHOT"),
    (10, 100, "INCREMENTAL"),
    (79, 100, "INCREMENTAL"),
    (80, 100, "REVIEW_REQUIRED"),
    (99, 100, "REVIEW_REQUIRED"),
]
IMPOSSIBLE = [(-1, 100), (101, 100), (0, -1)]


@pytest.mark.parametrize("changed, total, mode", CASES)
def test_load_mode(changed, total, mode):
    assert control.choose_load_mode(changed, total) == mode


@pytest.mark.parametrize("changed, total", IMPOSSIBLE)
def test_impossible_counts(changed, total):
    with pytest.raises(ValueError):
        control.choose_load_mode(changed, total)


def test_load_mode_column_agrees(spark):
    data = CASES + [(c, t, control.REJECTED) for c, t in IMPOSSIBLE]
    df = spark.createDataFrame(data, "c int, t int, mode string")
    wrong = df.filter(control.load_mode_of(F.col("c"), F.col("t")) != F.col("mode"))
    assert wrong.isEmpty()


def decide(spark, status, last_run, current, end):
    request = spark.createDataFrame(
        [("r1", "d1", end)],
        "pipeline_run_id string, dataset_id string, window_end timestamp",
    )
    runs = spark.createDataFrame(
        [("r1", status)] if status else [], "pipeline_run_id string, status string"
    )
    marks = spark.createDataFrame(
        [] if last_run == "absent" else [("d1", current, last_run)],
        "dataset_id string, watermark_value timestamp, "
        "last_successful_pipeline_run_id string",
    )
    return control.watermark_decisions(request, runs, marks).first()["decision"]


EARLY, LATE = datetime(2026, 1, 1), datetime(2026, 2, 1)


@pytest.mark.parametrize(
    "status, last_run, current, end, decision",
    [
        (None, "r0", EARLY, LATE, "RUN_NOT_FOUND"),
        ("RUNNING", "absent", None, LATE, "WATERMARK_NOT_FOUND"),
        ("SUCCESS", "r1", LATE, LATE, "ALREADY_FINALIZED"),
        ("SUCCESS", "r1", EARLY, LATE, "RUN_NOT_RUNNING"),
        ("SUCCESS", "r0", LATE, LATE, "RUN_NOT_RUNNING"),
        ("FAILED", "r0", EARLY, LATE, "RUN_NOT_RUNNING"),
        ("RUNNING", "r0", LATE, EARLY, "WATERMARK_WOULD_GO_BACK"),
        ("RUNNING", "r0", None, EARLY, "ADVANCE"),
        ("RUNNING", "r0", LATE, LATE, "ADVANCE"),
    ],
)
def test_watermark_decisions(spark, status, last_run, current, end, decision):
    assert decide(spark, status, last_run, current, end) == decision


def test_manifest_files_are_told_apart(spark):
    listed = [("a", 2, 10), ("b", 3, 10), ("b", 3, 10), ("c", 1, 10), ("d", 1, 10)]
    manifests = spark.createDataFrame(
        [("run", "SUCCESS", 5, 10, listed)],
        "run_id string, status string, pages_downloaded long, "
        "extracted_record_count long, files array<struct<file_name: string, "
        "record_count: long, file_size_bytes: long>>",
    )
    inventory = spark.createDataFrame(
        [("run", "a", 2, 10), ("run", "b", 3, 10), ("run", "c", 1, 11), ("run", "e", 1, 1)],
        "run_id string, file_name string, record_count long, file_size_bytes long",
    )
    entries = nested_entries(manifests)
    files = control.manifest_files(entries, inventory)
    assert rows(files.select("file_name", "problem")) == [
        ("a", None),
        ("b", "LISTED_TWICE"),
        ("c", "SIZE_DIFFERS"),
        ("d", "NOT_STORED"),
        ("e", "NOT_LISTED"),
    ]
    check = control.manifest_checks(manifests, entries, inventory).first()
    assert not check["accepted"]
    assert (check["names_unique"], check["pages_match"], check["records_match"]) == (
        False,
        True,
        True,
    )


def test_reconciliation_counts_repeats_and_nulls(spark):
    schema = "incident_report_number string, source_updated_at string"
    source = spark.createDataFrame(
        [("a", "1"), ("b", "1"), ("b", "2"), (None, "1"), ("c", None), ("d", "1"), ("x", "1")],
        schema,
    )
    target = spark.createDataFrame(
        [("a", "1"), ("b", "2"), (None, "1"), ("c", None), ("d", None), ("y", "1")], schema
    )
    states = reconcile.key_states(source, target)
    summary = reconcile.reconcile_summary(states).first().asDict()
    assert summary == {
        "source_count": 7,
        "source_unique_count": 6,
        "source_null_keys": 1,
        "source_repeated_keys": 1,
        "target_count": 6,
        "target_unique_count": 6,
        "target_null_keys": 1,
        "target_repeated_keys": 0,
        "missing_from_target": 2,
        "missing_from_source": 2,
        "timestamp_mismatches": 2,
    }
    key = "incident_report_number"
    mismatches = reconcile.timestamp_mismatches(states).select(key)
    assert rows(mismatches) == [("b",), ("d",)]
    assert rows(reconcile.missing_from_target(states)) == [("x", 1), (None, 1)]
    problems = rows(reconcile.reconcile_problems(reconcile.reconcile_summary(states)))
    assert len(problems) == 5


def test_reconciliation_of_nothing(spark):
    nothing = spark.createDataFrame(
        [], "incident_report_number string, source_updated_at string"
    )
    summary = reconcile.reconcile_summary(reconcile.key_states(nothing, nothing))
    assert set(summary.first()) == {0}


def test_summaries_compare_as_instants(spark):
    schema = "record_count long, max_updated_at string"
    one = spark.createDataFrame([(5, "2026-08-01T12:00:00.000Z")], schema)
    same = spark.createDataFrame([(5, "2026-08-01T14:00:00.000+02")], schema)
    empty = spark.createDataFrame([(5, None)], schema)
    verdict = lambda a, b: reconcile.compare_summaries(a, b).first()["summaries_match"]
    assert verdict(one, same)
    assert verdict(empty, empty)
    assert not verdict(one, empty)


def test_bag_diff_is_except_all_both_ways(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x")], "n int, t string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (3, "y")], "n int, t string")
    diff = quality.bag_diff(a, b, ["n", "t"])
    assert rows(diff) == [(1, None, 1), (3, "y", -1)]
    assert tuple(quality.bag_diff_counts(diff).first()) == (
        a.exceptAll(b).count(),
        b.exceptAll(a).count(),
    )
    assert tuple(quality.bag_diff_counts(quality.bag_diff(a, a, ["n", "t"])).first()) == (0, 0)


def test_model_checks(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (None, None)], "k int, n int")
    assert rows(quality.not_null(df, ["k", "n"])) == [("k", 1), ("n", 1)]
    assert rows(quality.unique(df, "k")) == [(2, 2)]
    assert rows(quality.accepted_values(df, "n", [1])) == [(2, 1)]
    with pytest.raises(QualityError, match="Repeated"):
        quality.require_empty(quality.unique(df, "k"), "Repeated keys.")
    more = spark.createDataFrame([(5,)], "incident_count int")
    less = spark.createDataFrame([(4,)], "incident_count int")
    assert rows(quality.totals_differ(more, less)) == [(5, 4)]
    assert rows(quality.totals_differ(more, more)) == []


def test_gates_keep_datasets_and_manifests_without_rows(spark):
    source = spark.createDataFrame([("a", "2024-01-02")], "dataset_id string, at string")
    source = source.select("dataset_id", F.col("at").cast("timestamp").alias("at"))
    marks = spark.sql(
        "SELECT explode(array('a', 'b')) AS dataset_id,"
        " timestamp'2024-01-01' AS watermark_value"
    )
    modes = control.load_modes(source, marks, "dataset_id", "at")
    found = {r["dataset_id"]: (r["load_mode"], r["source_record_count"]) for r in modes.collect()}
    assert found == {"a": (V.FULL_SNAPSHOT, 1), "b": (V.NO_CHANGES, 0)}
    manifests = spark.sql(
        "SELECT 'run' AS run_id, 'SUCCESS' AS status, 7L AS expected_record_count,"
        " 7L AS extracted_record_count"
    )
    counts = spark.sql("SELECT 'x' AS run_id, 1L AS actual_record_count").limit(0)
    verdicts = control.manifest_gate(manifests, counts).collect()
    assert [(r["verdict"], r["actual_record_count"]) for r in verdicts] == [(V.COUNT_MISMATCH, 0)]
