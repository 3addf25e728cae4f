"""Properties of the merge operators against a plain Python model."""

from compare import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import merge, staging

SCHEMA = (
    f"{V.BUSINESS_KEY} string, {V.UPDATED_AT} string, {V.VERSION} string, crime_type string"
)
TIMES = [None, *(f"2026-08-0{d}T12:00:00.000Z" for d in (1, 2, 3))]

record = st.tuples(st.sampled_from(TIMES), st.sampled_from([None, "1", "2", "10"]))
table = st.dictionaries(st.sampled_from("abcdefgh"), record, max_size=8)


def frame(spark, table, label):
    data = [(k, t, v, f"{label}-{k}") for k, (t, v) in table.items()]
    return spark.createDataFrame(data, SCHEMA)


def expected_merge(target, updates):
    result = {k: (t, v, f"old-{k}") for k, (t, v) in target.items()}
    for k, (time, version) in updates.items():
        if k in target:
            old_time, old_version = target[k]
            newer = old_time is None or (
                time is not None
                and (time > old_time or (time == old_time and version != old_version))
            )
            if not newer:
                continue
        result[k] = (time, version, f"new-{k}")
    return sorted(((k, *v) for k, v in result.items()), key=repr)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(target=table, updates=table)
def test_upsert_model(spark, target, updates):
    old, new = frame(spark, target, "old"), frame(spark, updates, "new")
    wanted = expected_merge(target, updates)
    for small in (False, True):
        merged = merge.upsert(old, new, small_updates=small)
        assert rows(merged) == wanted
        candidates = merge.merge_candidates(new, old, small_updates=small)
        names = {row[0] for row in candidates.select(V.BUSINESS_KEY).collect()}
        assert names == {k for k, *rest in wanted if rest[2].startswith("new")}

    stored = frame(spark, {k: (t, v) for k, t, v, _ in wanted}, "kept")
    # Idempotent, but for stored rows of unknown time, which any update replaces.
    again = merge.merge_candidates(new, stored).filter(
        F.col(f"target_{V.UPDATED_AT}").isNotNull()
    )
    assert again.isEmpty()


def test_unapplied_rows(spark):
    target = frame(spark, {"a": (TIMES[2], "1"), "b": (TIMES[1], "1"), "c": (None, "1")}, "x")
    updates = frame(
        spark,
        {"a": (TIMES[1], "1"), "b": (TIMES[1], "1"), "c": (TIMES[1], "1"), "d": (TIMES[1], "1")},
        "y",
    )
    for small in (False, True):
        left = merge.unapplied_rows(updates, target, small_updates=small)
        assert rows(left.select(V.BUSINESS_KEY)) == [("c",), ("d",)]


def test_text_and_typed_times_differ_on_mixed_formats(spark):
    target = frame(spark, {"a": ("2026-08-01T14:00:00.000+02", "1")}, "x")
    updates = frame(spark, {"a": ("2026-08-01T13:00:00.000Z", "1")}, "y")
    assert merge.merge_candidates(updates, target).count() == 1
    assert merge.merge_candidates(updates, target, compare=merge.TEXT).count() == 0


def test_upsert_replaces_every_matching_row(spark):
    target = frame(spark, {"a": (TIMES[1], "1")}, "x")
    twice = target.unionByName(target)
    updates = frame(spark, {"a": (TIMES[2], "1")}, "y")
    for small in (False, True):
        merged = merge.upsert(twice, updates, small_updates=small)
        assert rows(merged) == [("a", TIMES[2], "1", "y-a")] * 2


def test_upsert_of_chosen_columns_and_compound_keys(spark):
    schema = "a int, b int, n int, note string"
    target = spark.createDataFrame([(1, 1, 5, "kept"), (1, 2, 6, "kept")], schema)
    updates = spark.createDataFrame([(1, 1, 7, "new"), (2, 1, 8, "new")], schema)
    for small in (False, True):
        merged = merge.upsert(
            target,
            updates,
            ["a", "b"],
            updated_at=None,
            set_columns=["n"],
            small_updates=small,
        )
        assert rows(merged) == [(1, 1, 7, "kept"), (1, 2, 6, "kept"), (2, 1, 8, "new")]


def test_dedupe_orders_versions_as_numbers(spark):
    data = [
        ("a", TIMES[1], "9", "r1"),
        ("a", TIMES[1], "10", "r0"),
        ("a", None, "11", "r9"),
        ("b", TIMES[1], "1", "r1"),
        ("b", TIMES[1], "1", "r2"),
        (None, TIMES[1], "1", "r1"),
    ]
    names = (V.BUSINESS_KEY, V.UPDATED_AT, V.VERSION, V.ROW_ID)
    schema = ", ".join(f"{name} string" for name in names)
    df = spark.createDataFrame(data, schema)
    kept = rows(staging.dedupe_latest(df).select(V.BUSINESS_KEY, V.VERSION, V.ROW_ID))
    assert kept == [("a", "10", "r0"), ("b", "1", "r2"), (None, "1", "r1")]
    profile = staging.batch_profile(df).first()
    assert (profile["incoming_count"], profile["deduplicated_count"]) == (6, 3)


def test_snapshot_diff(spark):
    schema = "k int, a string, s string"
    old = spark.createDataFrame([(1, "x", "1"), (2, None, "1"), (3, "x", "1")], schema)
    new = spark.createDataFrame([(1, "x", "2"), (2, "y", "2"), (4, "x", "2")], schema)
    diff = merge.snapshot_diff(old, new, "k", ["a"], ["s"]).first().asDict()
    assert diff == {
        "inserted": 1,
        "removed": 1,
        "changed": 1,
        "unchanged": 1,
        "s_changed": 2,
    }
