"""Control tables as events, and digests of landed files."""

import os

import pytest
from compare import rows
from pyspark.sql import functions as F

from siltstone.operators import control
from siltstone.operators.quality import QualityError
from siltstone.plans import runs
from siltstone.plans.lake import Lake
from siltstone.registry.inputs import raw_incidents
from siltstone.sources import landing
from siltstone.sources.events import EventTable

SCHEMA = "k string, part int, v int"


def frame(spark, given):
    return spark.createDataFrame(given, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    schema = frame(spark, []).schema
    return EventTable(spark, str(tmp_path / "t"), schema, ["k", "part"], compact_after=4)


def files(table):
    found = []
    for folder, _, names in os.walk(table.path):
        found += [f"{folder}/{n}" for n in names if n.endswith(".parquet")]
    return found


def test_latest_event_of_each_id(spark, table):
    assert not table.exists()
    assert table.read().collect() == []
    assert table.compact() == 0
    table.append(frame(spark, [("a", 1, 1), ("b", 1, 2), (None, None, 3)]), "first")
    assert table.append(frame(spark, [("a", 1, 5)]), "second")
    assert rows(table.read()) == [("a", 1, 5), ("b", 1, 2), (None, None, 3)]
    assert rows(table.read(frame(spark, [("b", 1, 0)]))) == [("b", 1, 2)]


def test_a_repeated_event_changes_nothing(spark, table):
    table.append(frame(spark, [("a", 1, 1)]), "first")
    table.append(frame(spark, [("a", 1, 2)]), "second")
    before = files(table)
    assert not table.append(frame(spark, [("a", 1, 1)]), "first")
    assert files(table) == before
    assert rows(table.read()) == [("a", 1, 2)]
    assert table.compact() == 1
    assert not table.append(frame(spark, [("a", 1, 2)]), "second")


def test_one_event_is_one_file_until_compaction(spark, table):
    table.append(frame(spark, [(f"k{i}", i, i) for i in range(50)]).coalesce(1), "all")
    kept = files(table)
    for i in range(3):
        table.append(frame(spark, [("k7", 7, 100 + i)]).coalesce(1), f"event {i}")
        assert len(files(table)) == len(kept) + i + 1
    assert set(kept) <= set(files(table))
    assert table.base.latest() is None
    table.append(frame(spark, [("k7", 7, 200)]).coalesce(1), "event 3")
    assert table.base.latest()["record_count"] == 50
    table.append(frame(spark, [("k8", 8, 300)]).coalesce(1), "event 4")
    values = {r["k"]: r["v"] for r in table.read().collect()}
    assert (len(values), values["k7"], values["k8"]) == (50, 200, 300)
    assert rows(spark.sql(table.view_sql())) == rows(table.read())


def test_a_clock_that_goes_back_does_not_hide_events(spark, table, monkeypatch):
    table.append(frame(spark, [("a", 1, 1)]), "first")
    monkeypatch.setattr("siltstone.sources.events.time.time_ns", lambda: 5)
    table.append(frame(spark, [("a", 1, 2)]), "second")
    assert rows(table.read()) == [("a", 1, 2)]


def test_changed_bytes_are_found(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for name, text in (("a", "same"), ("b", "size"), ("c", "byte"), ("e", "extra")):
        (folder / f"part_{name}.json").write_text(text)
    glob = f"{folder}/{landing.PAGES_GLOB}"
    ledger = landing.page_checksums(spark, glob).filter("file_name <> 'part_e.json'")
    gone = ledger.filter("file_name = 'part_a.json'").withColumn("file_name", F.lit("gone"))
    blind = ledger.withColumn("checksum_sha256", F.lit(None).cast("string"))
    ledger = spark.createDataFrame(ledger.unionByName(gone).collect(), ledger.schema)
    blind = spark.createDataFrame(blind.collect(), blind.schema)
    (folder / "part_b.json").write_text("sizes")
    (folder / "part_c.json").write_text("Byte")
    stored = landing.page_checksums(spark, glob)
    found = control.changed_files(ledger, stored).select("file_name", "problem")
    assert rows(found) == [
        ("gone", "NOT_STORED"),
        ("part_b.json", "SIZE_DIFFERS"),
        ("part_c.json", "CONTENT_DIFFERS"),
        ("part_e.json", "NOT_REGISTERED"),
    ]
    by_size = control.changed_files(blind, stored).select("file_name")
    assert rows(by_size) == [("part_b.json",), ("part_e.json",)]


def test_a_load_refuses_pages_changed_after_landing(spark, sf_dir, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    land = runs._land_batch

    def tampered(lake, rows, prefix, **rest):
        landed = land(lake, rows, prefix, **rest)
        page = sorted((tmp_path / "raw" / "run-0").glob("part*.json"))[0]
        page.write_bytes(page.read_bytes().replace(b"STREET", b"STREAT", 1))
        for crc in page.parent.glob(f".{page.name}.crc"):
            crc.unlink()
        return landed

    monkeypatch.setattr(runs, "_land_batch", tampered)
    with pytest.raises(QualityError, match="CONTENT_DIFFERS"):
        runs.bootstrap(
            lake,
            raw_incidents(spark, sf_dir),
            dataset_id="incidents",
            landing_root=str(tmp_path / "raw"),
            run_id="run-0",
        )
    assert not lake.bronze.exists()
    registered = lake.control_files()
    assert registered.filter("checksum_sha256 IS NULL").count() == 0 < registered.count()
    assert lake.control_runs().first()["status"] == "FAILED"
