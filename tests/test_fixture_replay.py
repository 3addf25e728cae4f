"""Replay of the two landed fixture batches with their published counts."""

import json

import pytest
from compare import rows

from siltstone import values as V
from siltstone.operators.quality import QualityError
from siltstone.plans.lake import Lake
from siltstone.plans.layers import LoadReport, load_base
from siltstone.sources.landing import scan_batch, scan_manifest

FIELDS = [":id", ":version", ":created_at", ":updated_at", V.BUSINESS_KEY, "crime_type"]
FIRST = "2026-08-01T12:00:00.000Z"
SECOND = "2026-08-02T12:00:00.000Z"

INITIAL = [
    ("fixture-row-100", "1", FIRST, FIRST, "FIXTURE-100", "THEFT"),
    ("fixture-row-200", "1", FIRST, FIRST, "FIXTURE-200", "BURGLARY"),
]
INCREMENTAL = [
    *INITIAL,
    ("fixture-row-200", "2", FIRST, SECOND, "FIXTURE-200", "BURGLARY OF VEHICLE"),
    ("fixture-row-300", "1", SECOND, SECOND, "FIXTURE-300", "AUTO THEFT"),
]


def land(root, run_id, records, status="SUCCESS", expected=None):
    folder = root / run_id
    folder.mkdir(parents=True)
    body = [dict(zip(FIELDS, record, strict=True)) for record in records]
    (folder / "part_0001.json").write_text(json.dumps(body))
    manifest = {
        "run_id": run_id,
        "status": status,
        "expected_record_count": len(records) if expected is None else expected,
        "extracted_record_count": len(records),
    }
    (folder / "manifest.json").write_text(json.dumps(manifest, indent=2))
    return str(folder)


def load(lake, prefix, run_id, **options):
    return load_base(lake, prefix, run_id=run_id, dataset_id="fixture", **options)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.mark.parametrize(
    "compare, options",
    [
        ("typed", {}),
        ("text", {}),
        ("typed", {"base_buckets": 4}),
        ("typed", {"key_buckets": 4}),
        ("text", {"key_buckets": 1}),
    ],
)
def test_create_merge_and_rerun(spark, tmp_path, compare, options):
    lake = Lake(spark, str(tmp_path / "lake"), **options)
    initial = land(tmp_path / "raw", "fixture_initial", INITIAL)
    incremental = land(tmp_path / "raw", "fixture_incremental", INCREMENTAL)

    created = load(lake, initial, "fixture_initial", compare=compare)
    assert created == LoadReport(2, 2, None, 2, True)

    merged = load(lake, incremental, "fixture_incremental", compare=compare)
    assert merged == LoadReport(4, 3, 2, 3, True)

    expected = [
        ("FIXTURE-100", "THEFT", "1", "fixture_initial"),
        ("FIXTURE-200", "BURGLARY OF VEHICLE", "2", "fixture_incremental"),
        ("FIXTURE-300", "AUTO THEFT", "1", "fixture_incremental"),
    ]
    columns = [V.BUSINESS_KEY, "crime_type", V.VERSION, "ingestion_run_id"]
    assert rows(lake.bronze.read().select(*columns)) == expected

    again = load(lake, incremental, "fixture_incremental", compare=compare)
    assert again == LoadReport(4, 3, 0, 3, False)
    operations = lake.bronze.history().orderBy("version").select("operation").collect()
    assert [row[0] for row in operations] == ["append", "overwrite"]


def test_snapshot_removes_what_it_lacks(lake, tmp_path):
    load(lake, land(tmp_path / "raw", "one", INITIAL), "one")
    snapshot = land(tmp_path / "raw", "two", [INITIAL[1], INCREMENTAL[3]])
    report = load(lake, snapshot, "two", full_snapshot=True)
    assert report == LoadReport(2, 2, None, 2, True)
    keys = rows(lake.bronze.read().select(V.BUSINESS_KEY))
    assert keys == [("FIXTURE-200",), ("FIXTURE-300",)]
    assert rows(lake.bronze.read(version=1).select(V.BUSINESS_KEY))[0] == ("FIXTURE-100",)


@pytest.mark.parametrize(
    "records, options, message",
    [
        ([], {}, "no records"),
        ([(*INITIAL[0][:4], "  ", "X")], {}, "business key"),
        ([("", *INITIAL[0][1:])], {}, "source row id"),
        ([(*INITIAL[0][:3], None, *INITIAL[0][4:])], {}, "update time"),
        (INCREMENTAL, {"full_snapshot": True}, "one record per key"),
    ],
)
def test_bad_batches_are_refused(lake, tmp_path, records, options, message):
    prefix = land(tmp_path / "raw", "bad", records)
    with pytest.raises(QualityError, match=message):
        load(lake, prefix, "bad", **options)
    assert not lake.bronze.exists()


@pytest.mark.parametrize("broken", [{"status": "PARTIAL"}, {"expected": 5}])
def test_snapshot_needs_its_manifest(lake, tmp_path, broken):
    prefix = land(tmp_path / "raw", "snap", INITIAL, **broken)
    with pytest.raises(QualityError, match="manifest"):
        load(lake, prefix, "snap", full_snapshot=True)


def test_inferred_and_extra_columns(spark, tmp_path):
    prefix = land(tmp_path / "raw", "one", INITIAL)
    declared = scan_batch(spark, prefix, extra_columns=("not_there",))
    assert declared.columns[-1] == "not_there"
    assert declared.filter("not_there IS NULL AND district IS NULL").count() == 2
    inferred = scan_batch(spark, prefix, schema=None)
    assert set(inferred.columns) == set(declared.columns) - {"not_there"}
    assert dict(inferred.dtypes)[":version"] == "string"


def test_unparsable_times_are_refused_before_a_commit(spark, tmp_path, lake):
    load(lake, land(tmp_path / "raw", "fixture_initial", INITIAL), "fixture_initial")
    broken = ("r", "1", FIRST, "not a time", "FIXTURE-900", "THEFT")
    prefix = land(tmp_path / "raw", "broken", [broken])
    with pytest.raises(QualityError, match="not instants"):
        load(lake, prefix, "broken")
    assert lake.bronze.history().count() == 1
    loaded = load(lake, prefix, "broken", compare="text")
    assert loaded == LoadReport(1, 1, 1, 3, True)


def test_names_show_the_latest_version(spark, tmp_path, lake):
    load(lake, land(tmp_path / "raw", "fixture_initial", INITIAL), "fixture_initial")
    names = lake.publish()
    load(lake, land(tmp_path / "raw", "more", INCREMENTAL), "more")
    lake.publish(only_named=True)
    assert [spark.table(n).count() for n in names] == [3]


def test_both_manifest_layouts(spark, tmp_path):
    for name in ("extracted_record_count", "records_downloaded"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "manifest.json").write_text(json.dumps({"status": "SUCCESS", name: 7}))
        assert scan_manifest(spark, str(folder)).first()["extracted_record_count"] == 7
