import json

import pytest
from compare import rows
from pyspark.errors import StreamingQueryException
from test_fixture_replay import FIRST, INCREMENTAL, INITIAL, land

from siltstone import values as V
from siltstone.plans.lake import Lake
from siltstone.streaming.landed_pages import load_new_runs


def stream(lake, tmp_path, reports, refused=None):
    query = load_new_runs(
        lake,
        str(tmp_path / "raw"),
        str(tmp_path / "checkpoint"),
        dataset_id="fixture",
        on_load=reports.append,
        on_refusal=(refused if refused is not None else []).append,
    )
    query.awaitTermination(120)
    return [(r.incoming, r.deduplicated, r.merged, r.saved) for r in reports]


def stored(lake):
    return rows(lake.bronze.read().select(V.BUSINESS_KEY, V.VERSION))


def test_runs_are_loaded_once_and_merged(spark, tmp_path):
    lake, reports = Lake(spark, str(tmp_path / "lake")), []
    land(tmp_path / "raw", "fixture_initial", INITIAL)
    assert stream(lake, tmp_path, reports) == [(2, 2, None, 2)]
    land(tmp_path / "raw", "fixture_incremental", INCREMENTAL)
    assert stream(lake, tmp_path, reports)[1:] == [(4, 3, 2, 3)]
    assert len(stream(lake, tmp_path, reports)) == 2
    assert stored(lake) == [
        ("FIXTURE-100", "1"),
        ("FIXTURE-200", "2"),
        ("FIXTURE-300", "1"),
    ]


def test_pages_of_a_run_are_one_load(spark, tmp_path):
    """Version 2 on the first page and version 1 on the second: 2 stays."""
    lake, reports = Lake(spark, str(tmp_path / "lake")), []
    two, one = (("r", v, FIRST, FIRST, "K", "THEFT") for v in ("2", "1"))
    folder = land(tmp_path / "raw", "run", [two], expected=2)
    land(tmp_path / "other", "run", [one])
    page = tmp_path / "other" / "run" / "part_0001.json"
    (tmp_path / "raw" / "run" / "part_0002.json").write_text(page.read_text())
    assert folder and stream(lake, tmp_path, reports) == [(2, 1, None, 1)]
    assert stored(lake) == [("K", "2")]


def test_partial_runs_wait_and_snapshots_replace(spark, tmp_path):
    lake, reports, refused = Lake(spark, str(tmp_path / "lake")), [], []
    land(tmp_path / "raw", "a_initial", INITIAL)
    stream(lake, tmp_path, reports)
    land(tmp_path / "raw", "b_partial", INCREMENTAL, status="PARTIAL")
    stream(lake, tmp_path, reports, refused)
    assert [r["status"] for r in refused] == ["PARTIAL"] and len(reports) == 1
    land(tmp_path / "raw", "c_snapshot", INITIAL[:1])
    path = tmp_path / "raw" / "c_snapshot" / "manifest.json"
    manifest = json.loads(path.read_text()) | {"load_mode": V.FULL_SNAPSHOT}
    path.write_text(json.dumps(manifest))
    stream(lake, tmp_path, reports)
    assert stored(lake) == [("FIXTURE-100", "1")]
    # The other layout of a manifest, with a right count and with a wrong one.
    for name, count, rows_left in (("d_same", 2, 2), ("e_wrong", 3, 2)):
        land(tmp_path / "raw", name, INITIAL)
        path = tmp_path / "raw" / name / "manifest.json"
        manifest = json.loads(path.read_text()) | {"load_mode": V.FULL_SNAPSHOT}
        del manifest["extracted_record_count"]
        path.write_text(json.dumps(manifest | {"records_downloaded": count}))
        if count == 2:
            stream(lake, tmp_path, reports)
        else:
            with pytest.raises(StreamingQueryException, match="matching SUCCESS manifest"):
                stream(lake, tmp_path, reports)
        assert len(stored(lake)) == rows_left
