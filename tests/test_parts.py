"""Tables in parts: what a change writes, and layers carried on by differences."""

from datetime import date

import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import deltas, marts, merge
from siltstone.operators.deltas import Changes
from siltstone.operators.quality import QualityError
from siltstone.operators.standardize import enrich, incident_fact, standardize
from siltstone.plans import layers, runs, touched
from siltstone.plans.lake import Lake
from siltstone.plans.touched import merge_touched, replaced_keys
from siltstone.registry import inputs as given
from siltstone.sources.parts import PartTable

TARGET = "incident_report_number string, source_updated_at string, source_version string, v int"


def time(day):
    return f"2026-08-{day:02d}T12:00:00.000Z"


def keyed(spark, path, given_rows, buckets=8):
    table = PartTable.by_key(spark, str(path), V.BUSINESS_KEY, buckets)
    table.replace(spark.createDataFrame(given_rows, TARGET))
    return table


def folders(table):
    return {name: path for name, (path, _) in table.version().parts.items()}


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", [(f"k{i}", time(1), "1", i) for i in range(60)])
    before = folders(table)
    assert len(before) == 8
    updates = spark.createDataFrame(
        [("k1", time(2), "1", -1), ("new", time(1), "1", -2), ("k2", time(1), "1", -3)],
        TARGET,
    )
    found = merge_touched(table, updates)
    after = folders(table)
    assert found.merged == 2
    changed = {name for name in before if before[name] != after[name]}
    assert changed == set(found.parts) and 1 <= len(changed) <= 2
    assert set(after) == set(before)
    values = {r[V.BUSINESS_KEY]: r["v"] for r in table.read().collect()}
    assert (values["k1"], values["new"], values["k2"], len(values)) == (-1, -2, 2, 61)
    assert rows(found.changes.old.select("v")) == [(1,)]
    assert rows(found.changes.new.select("v")) == [(-1,), (-2,)]

    again = merge_touched(table, updates)
    assert (again.merged, again.changes, folders(table)) == (0, None, after)
    first = table.version(1)
    assert first.parts.keys() == before.keys() and table.read(version=first).count() == 60


def test_merge_in_parts_equals_upsert(spark, tmp_path):
    """Repeated, NULL and unknown keys, times and versions, in both joins."""
    target = [(f"k{i % 25}", time(1 + i % 3) if i % 7 else None, "1", i) for i in range(40)]
    target += [(None, time(1), "1", 100), (None, None, None, 101)]
    updates = [(f"k{i}", time(2), "12"[i % 2] if i % 5 else None, -i) for i in range(40)]
    new = spark.createDataFrame(updates, TARGET)
    expected = rows(merge.upsert(spark.createDataFrame(target, TARGET), new))
    table = keyed(spark, tmp_path / "t", target, 5)
    merge_touched(table, new)
    assert rows(table.read()) == expected


def test_merge_into_empty_table(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", [])
    assert table.read().columns == [V.BUSINESS_KEY, V.UPDATED_AT, V.VERSION, "v"]
    none = spark.createDataFrame([], TARGET)
    assert merge_touched(table, none).merged == 0
    merge_touched(table, spark.createDataFrame([("a", time(1), "1", 1)], TARGET))
    assert table.latest()["record_count"] == 1
    table.replace(none)
    assert table.version().parts == {}
    assert spark.sql(table.view_sql()).collect() == []


def test_large_parts_keep_their_rows_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Only new rows are shuffled; a batch that replaces row by row is not joined again."""
    target = [(f"k{i}", time(1), "1", i) for i in range(60)]
    updates = [(f"k{i}", time(2), "1", -i) for i in range(50, 70)]
    new = spark.createDataFrame(updates, TARGET)
    expected = rows(merge.upsert(spark.createDataFrame(target, TARGET), new))
    table = keyed(spark, tmp_path / "t", target)
    written = []

    def write(self, df, folder=None, spread=True):
        written.append((df.count(), spread, "hashpartitioning" in plan(df)))
        return store(self, df, folder, spread)

    store = PartTable.write
    monkeypatch.setattr(PartTable, "write", write)
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(merge, "upsert", None)
    found = merge_touched(table, new)
    assert written == [(20, True, False), (50, False, False)]
    assert rows(table.read()) == expected
    assert rows(found.changes.new) == rows(new)
    assert rows(found.changes.old) == sorted(target[50:], key=repr)


@pytest.mark.parametrize("bound", [0, 4])
def test_keys_past_the_bound_go_a_few_parts_at_once(spark, tmp_path, monkeypatch, bound):
    target = [(f"k{i % 25}", time(1 + i % 3) if i % 7 else None, "1", i) for i in range(40)]
    target += [(None, time(1), "1", 100)]
    updates = [(f"k{i}", time(2), "12"[i % 2] if i % 5 else None, -i) for i in range(40)]
    new = spark.createDataFrame(updates, TARGET)
    expected = rows(merge.upsert(spark.createDataFrame(target, TARGET), new))
    table = keyed(spark, tmp_path / "t", target, 5)
    monkeypatch.setattr(touched, "BROADCAST_KEYS", bound)
    merge_touched(table, new)
    assert rows(table.read()) == expected


def test_other_buckets_are_not_opened(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", [(f"k{i}", time(1), "1", i) for i in range(60)])
    wanted = table.labels(spark.createDataFrame([("k3", time(1), "1", 3)], TARGET))
    read = table.read(wanted)
    assert len(read.inputFiles()) < len(table.read().inputFiles())
    assert all(f"{wanted[0]}/" in name for name in read.inputFiles())
    assert "k3" in {r[0] for r in read.collect()}


def test_another_rule_is_refused(spark, tmp_path):
    keyed(spark, tmp_path / "t", [("a", time(1), "1", 1)])
    other = PartTable.by_key(spark, str(tmp_path / "t"), V.BUSINESS_KEY, 9)
    with pytest.raises(ValueError, match="8 buckets"):
        other.read()


DATED = "incident_report_number string, occ_date date, v int"


def changes(spark, old, new):
    def frame(given_rows):
        return spark.createDataFrame(given_rows, DATED)

    keys = frame([*old, *new]).select(V.BUSINESS_KEY).distinct()
    return Changes(frame(old), frame(new), keys, 1)


def test_touched_years_and_the_year_of_no_date(spark, tmp_path):
    table = PartTable.by_year(spark, str(tmp_path / "t"), "occ_date")
    stored = [
        ("a", date(2001, 1, 1), 1), ("b", date(2001, 5, 1), 2), ("c", date(2002, 1, 1), 3),
        ("d", None, 4), ("e", date(2003, 1, 1), 5), ("f", None, 6),
    ]
    table.replace(spark.createDataFrame(stored, DATED))
    before = folders(table)
    assert set(before) == {"y2001", "y2002", "y2003", "none"}
    # a loses its date, d gets one in a new year, the only row of 2002 moves to 2001.
    old = [stored[0], stored[2], stored[3]]
    new = [("a", None, 10), ("c", date(2001, 9, 9), 30), ("d", date(2010, 1, 1), 40)]
    touched = replaced_keys(table, changes(spark, old, new))
    after = folders(table)
    assert set(touched) == {"y2001", "y2002", "none", "y2010"}
    assert set(after) == {"y2001", "y2003", "none", "y2010"}
    assert after["y2003"] == before["y2003"]
    assert rows(table.read()) == sorted(
        [*new, stored[1], stored[4], stored[5]], key=repr
    )


def test_a_change_of_other_rows_is_refused(spark, tmp_path):
    table = PartTable.by_year(spark, str(tmp_path / "t"), "occ_date")
    table.replace(spark.createDataFrame([("a", date(2001, 1, 1), 1)], DATED))
    wrong = changes(spark, [("b", date(2001, 1, 1), 1)], [("b", date(2001, 1, 2), 2)])
    with pytest.raises(QualityError, match="expected"):
        replaced_keys(table, wrong)
    assert table.latest()["version"] == 1


def test_groups_fall_to_zero_and_below(spark):
    stored = spark.createDataFrame(
        [(date(2001, 1, 1), "A", None, 1, 1, 1, 0), (None, None, 2, 3, 0, 0, 0)],
        "occ_month date, crime_type string, council_district int, incident_count long, "
        "known_clearance_count long, cleared_count long, family_violence_count long",
    )
    delta = stored.withColumns({m: -F.col(m) for m in marts.TREND_MEASURES})
    left = deltas.changed_summary(stored, delta.filter("crime_type = 'A'"))
    assert rows(left) == [(None, None, 2, 3, 0, 0, 0)]
    below = deltas.changed_summary(left, delta)
    assert deltas.negative_groups(below, marts.TREND_MEASURES).count() == 1


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(spark, str(root / "tables"), key_buckets=8)
    lake.raw_root = str(root / "raw")
    source = given.raw_incidents(spark, sf_dir)
    runs.bootstrap(lake, source, **where(lake, "run-0"))
    return lake


def where(lake, run_id):
    return {"dataset_id": "incidents", "landing_root": lake.raw_root, "run_id": run_id}


def require_layers_as_rebuilt(lake):
    clean = standardize(lake.bronze.read())
    fact = incident_fact(enrich(clean))
    for table, expected in (
        (lake.silver, clean),
        (lake.fact, fact),
        (lake.summary, marts.monthly_summary(clean)),
        (lake.trends, marts.monthly_trends(fact)),
        (lake.rates, marts.clearance_rates(fact)),
    ):
        found = table.read().select(*expected.columns)
        assert rows(found) == rows(expected), table.path


def test_daily_loads_carry_the_layers_on(lake, sf_dir):
    source = given.raw_incidents(lake.spark, sf_dir)
    require_layers_as_rebuilt(lake)
    late = F.col("occ_date") >= "2001-06"
    moved = source.withColumns(
        {
            ":updated_at": F.when(late, time(5)).otherwise(F.col(":updated_at")),
            "occ_date": F.when(late, "2000-02-03T00:00:00.000").otherwise(F.col("occ_date")),
            "council_district": F.when(late, "4").otherwise(F.col("council_district")),
        }
    )
    before = folders(lake.silver)
    loaded = runs.daily_load(lake, moved, **where(lake, "run-1"))
    assert loaded["load_mode"] == V.INCREMENTAL and loaded["load"].merged > 0
    after = folders(lake.silver)
    kept = {name for name in before if before[name] == after.get(name)}
    assert kept >= {"y1996", "y1997", "y1998", "y1999"}
    assert {"y2000", "y2001"} & kept == set()
    require_layers_as_rebuilt(lake)
    assert layers.refresh(lake, loaded["load"].changes) == dict.fromkeys(
        ["silver", "fact", "summary", "trends", "rates"], "current"
    )


def test_layers_that_missed_a_change_are_built(lake, sf_dir):
    """As after a run that failed between the base table and its layers."""
    first = merge_touched(lake.bronze, given.moved_batch(lake.spark, sf_dir, 1))
    layers.build_gold(lake)  # from an older Silver, but says so only by its version
    lake.summary.commit(lake.summary.latest()["path"], 1)
    second = merge_touched(lake.bronze, given.moved_batch(lake.spark, sf_dir, 2))
    assert first.merged and second.merged
    assert set(layers.refresh(lake, second.changes).values()) == {"built"}
    require_layers_as_rebuilt(lake)


def test_parts_are_published(lake):
    names = lake.publish()
    assert {"bronze.incident_reports", "marts.incident_fact"} <= set(names)
    count = lake.spark.sql("SELECT count(*) FROM silver.incident_reports").first()[0]
    assert count == lake.silver.latest()["record_count"]
    one_year = lake.spark.sql("SELECT v.* FROM silver.incident_reports v")
    assert "_part" not in one_year.columns and "Python" not in plan(one_year)
