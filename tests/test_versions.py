"""Differences between stored versions, expiry, and pages by directory."""

import os

import pytest
from compare import rows
from pyspark.sql import functions as F

from siltstone.operators import merge
from siltstone.plans.touched import merge_touched
from siltstone.registry import inputs as given
from siltstone.sources import changes, tables
from siltstone.sources.events import EventTable
from siltstone.sources.expiry import expire
from siltstone.sources.files import children, delete
from siltstone.sources.pages import KeyPages
from siltstone.sources.parts import PartTable
from siltstone.sources.tables import VersionedTable

SCHEMA = "incident_report_number string, source_updated_at string, source_version string, v int"
KEY = "incident_report_number"


def time(day):
    return f"2026-08-{day:02d}T12:00:00.000Z"


def frame(spark, given_rows):
    return spark.createDataFrame(given_rows, SCHEMA)


def three_versions(spark, path):
    table = PartTable.by_key(spark, str(path), KEY, 8)
    table.replace(frame(spark, [(f"k{i}", time(1), "1", i) for i in range(60)]))
    merge_touched(table, frame(spark, [("k1", time(2), "1", -1), ("new", time(1), "1", 0)]))
    merge_touched(table, frame(spark, [("k2", time(2), "1", -2)]))
    return table


def test_only_parts_that_differ_are_joined(spark, tmp_path):
    table = three_versions(spark, tmp_path / "t")
    for old, new in ((1, 2), (1, 3), (2, 3), (3, 1), (2, 2)):
        found = merge.version_diff(table, old, new, KEY, ["v"], ["source_updated_at"])
        whole = merge.snapshot_diff(
            table.read(version=table.version(old)),
            table.read(version=table.version(new)),
            KEY, ["v"], ["source_updated_at"],
        )
        assert rows(found) == rows(whole), (old, new)
    opened = merge.version_diff(table, 2, 3, KEY, ["v"])
    assert len(opened.inputFiles()) == 2


def test_rows_that_move_between_parts(spark, tmp_path):
    schema = "k string, d date, v int"
    table = PartTable.by_year(spark, str(tmp_path / "t"), "d")
    first = spark.sql("SELECT 'a' AS k, DATE '2001-01-01' AS d, 1 AS v "
                      "UNION ALL SELECT 'b', DATE '2002-01-01', 2 "
                      "UNION ALL SELECT 'c', NULL, 3")  # fmt: skip
    table.replace(first)
    moved = first.withColumn("d", F.when(F.col("k") != "a", F.col("d")))
    table.replace(spark.createDataFrame(moved.collect(), schema))
    found = merge.version_diff(table, 1, 2, "k", ["v"], ["d"]).first()
    assert found.asDict() == {
        "inserted": 0, "removed": 0, "changed": 0, "unchanged": 3, "d_changed": 1
    }


def parquet_files(folder):
    return {f"{d}/{n}" for d, _, names in os.walk(folder) for n in names if n.endswith("parquet")}


def test_expired_parts_are_gone_and_kept_versions_readable(spark, tmp_path):
    table = three_versions(spark, tmp_path / "t")
    states = {n: rows(table.read(version=table.version(n))) for n in (1, 2, 3)}
    orphan = table.write(frame(spark, [("lost", time(1), "1", 0)]))
    before = parquet_files(tmp_path)
    assert expire(table, keep=2)
    assert not os.path.exists(orphan)
    for number in (2, 3):
        assert rows(table.read(version=table.version(number))) == states[number]
    with pytest.raises(ValueError, match="No such table version"):
        table.version(1)
    expire(table, keep=1)
    assert rows(table.read()) == states[3]
    assert parquet_files(tmp_path) < before
    listed = {path for path, _ in table.version().parts.values()}
    held = {os.path.dirname(f) for f in parquet_files(tmp_path / "t" / "data")}
    assert held == listed
    assert expire(table, keep=1) == []
    merge_touched(table, frame(spark, [("k5", time(3), "1", -5)]))
    assert table.latest()["version"] == 4
    with pytest.raises(ValueError, match="has to stay"):
        expire(table, keep=0)


def test_expiry_of_whole_versions_and_logs(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"))
    for number in range(4):
        table.replace(spark.range(number + 1))
    assert len(expire(table, keep=2)) == 2
    assert [table.read(n).count() for n in (3, 4)] == [3, 4]
    assert table.history().count() == 2
    log = EventTable(spark, str(tmp_path / "e"), spark.range(1).schema, ["id"])
    assert expire(log) == []
    log.append(spark.range(5), "one")
    log.compact()
    log.append(spark.range(5, 7), "two")
    log.compact()
    log.append(spark.range(7, 8), "three")
    assert len(expire(log)) == 3
    assert log.read().count() == 8
    assert not log.append(spark.range(7, 8), "three")


def test_staged_folders_go_at_the_end_of_a_job(spark):
    mine = list(tables._STAGED)
    tables._STAGED.clear()
    kept = tables.staged(spark.range(3), "purpose")
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder)
    assert tables.release_staged(spark) == 1
    assert not os.path.exists(folder)
    assert tables.release_staged(spark) == 0
    tables._STAGED.extend(mine)


def test_folders_that_do_not_exist(spark, tmp_path):
    assert children(spark, str(tmp_path / "none")) == []
    assert not delete(spark, str(tmp_path / "none"))


def test_every_page_equals_the_plain_one(spark, sf_dir, tmp_path):
    orders = given.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pages = KeyPages(spark, str(tmp_path / "p"), "o_orderkey")
    pages.write(orders, page_size=100)
    total = len(pages.directory().collect())
    after, seen = None, 0
    while True:
        page = pages.page(after, 350)
        found = [tuple(r) for r in page.collect()]
        plain = changes.keyset_page(orders, F.col("o_orderkey"), after, 350).collect()
        assert found == [tuple(r) for r in plain]
        seen += len(found)
        if not found:
            break
        assert len(page.inputFiles()) <= 6 < total
        after = found[-1][0]
    assert seen == orders.count()


def test_pages_with_nulls_and_equal_keys(spark, tmp_path):
    values = [None] * 5 + [1] * 30 + [2] * 3 + list(range(10, 20))
    source = spark.createDataFrame([(v,) for v in values], "k int")
    pages = KeyPages(spark, str(tmp_path / "p"), "k")
    pages.write(source, page_size=4)
    for after, size in ((None, 3), (None, 20), (1, 2), (1, 100), (15, 4), (19, 4)):
        plain = changes.keyset_page(source, F.col("k"), after, size)
        assert [r[0] for r in pages.page(after, size).collect()] == [
            r[0] for r in plain.collect()
        ], (after, size)
    none = KeyPages(spark, str(tmp_path / "none"), "k")
    none.write(source.limit(0))
    assert none.page().collect() == none.page(3).collect() == []
