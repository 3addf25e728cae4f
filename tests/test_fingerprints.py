"""Key ranges compared by fingerprints, and model tests from one scan."""

import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import fingerprints, quality, reconcile
from siltstone.operators.quality import QualityError
from siltstone.plans import layers
from siltstone.plans.lake import Lake
from siltstone.registry import inputs as given

KEY, TIME = V.BUSINESS_KEY, V.UPDATED_AT
SCHEMA = f"{KEY} string, {TIME} string"


def keys(n, changed=(), gone=(), extra=()):
    found = [(f"k{i:05d}", "t2" if i in changed else "t1") for i in range(n) if i not in gone]
    return [*found, *extra]


def both(spark, source, target, ranges=16):
    frames = [spark.createDataFrame(side, SCHEMA) for side in (source, target)]
    return (*frames, *fingerprints.differing(*frames, ranges=ranges))


CASES = {
    "equal": (keys(400), keys(400)),
    "one time": (keys(400), keys(400, changed={7})),
    "null time": (keys(400), [*keys(399), ("k00399", None)]),
    "one missing": (keys(400, gone={3}), keys(400, gone={390})),
    "swapped times": (keys(400, changed={1}), keys(400, changed={2})),
    "null keys": ([*keys(400), (None, "t1")], [*keys(400), (None, "t1")]),
    "repeated in the source": ([*keys(400), ("k00009", "t1")], keys(400)),
    "outside the limits": (keys(400, extra=[("a", "t1"), ("zzz", "t1")]), keys(400)),
    "no target": (keys(5), []),
    "no source": ([], keys(5)),
    "nothing": ([], []),
    "one key": (keys(1), keys(1)),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows_as_the_full_comparison(spark, name):
    source, target, left, right, equal = both(spark, *CASES[name])
    whole = reconcile.key_states(source, target)
    opened = reconcile.key_states(left, right)
    for question in (
        reconcile.missing_from_target,
        reconcile.missing_from_source,
        reconcile.timestamp_mismatches,
    ):
        assert rows(question(opened)) == rows(question(whole))
    summary = fingerprints.with_equal_rows(reconcile.reconcile_summary(opened), equal)
    assert rows(summary) == rows(reconcile.reconcile_summary(whole))


def test_equal_ranges_are_not_joined(spark, tmp_path):
    source, target, left, right, equal = both(spark, *CASES["one time"])
    assert 0 < left.count() == right.count() < 60
    assert equal == 400 - left.count()
    target.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    _, read, _ = fingerprints.differing(source, stored, ranges=16)
    text = plan(read)
    assert f"LessThan({KEY}" in text.split("PushedFilters: [")[1]


def test_ranges_cover_every_key_once(spark):
    df = spark.createDataFrame([*keys(300), (None, "t"), ("", "t"), ("ü", "t")], SCHEMA)
    limits = fingerprints.range_limits(df, KEY, 8)
    assert len(limits) == 7
    numbered = df.withColumn("range", fingerprints.range_of(F.col(KEY), limits))
    for number in (fingerprints.NO_KEY, *range(8)):
        inside = df.filter(fingerprints.in_ranges(F.col(KEY), limits, [number]))
        assert rows(inside) == rows(numbered.filter(F.col("range") == number).drop("range"))
    assert fingerprints.range_limits(df, KEY, 1) == []


def test_fingerprints_do_not_depend_on_order_and_count_repeats(spark):
    once = spark.createDataFrame(keys(50), SCHEMA)
    shuffled = once.orderBy(F.desc(KEY)).repartition(3)
    assert rows(fingerprints.fingerprints(once, [])) == rows(
        fingerprints.fingerprints(shuffled, [])
    )
    twice = fingerprints.fingerprints(once.union(once), []).first()
    assert twice["rows"] == 100
    assert twice["low_sum"] == 2 * fingerprints.fingerprints(once, []).first()["low_sum"]


TESTS = quality.ModelTests(
    not_null=("a", "b"), unique=("a", "b"), accepted=(("c", (1, 2)),), sums=("c",)
)


def test_model_profile_finds_the_same_violations(spark):
    df = spark.createDataFrame(
        [("x", "p", 1), ("x", None, 2), ("y", "q", 3), (None, "q", None), (None, "q", 1)],
        "a string, b string, c int",
    )
    profile = quality.model_profile(df, TESTS).first()
    assert profile.asDict() == {
        "rows": 5, "null_a": 2, "null_b": 1, "repeated_a": 1, "repeated_b": 2,
        "outside_c": 1, "sum_c": 7,
    }
    nulls = {r["column_name"]: r["null_count"] for r in quality.not_null(df, ["a", "b"]).collect()}
    assert nulls == {"a": profile["null_a"], "b": profile["null_b"]}
    for name in "ab":
        extra = quality.unique(df, name).agg(F.sum("record_count") - F.count("*")).first()[0]
        assert extra == profile[f"repeated_{name}"]
    found = quality.model_violations(df, TESTS, profile)
    assert len(found) == 5 and "'value': 'x'" in found[2]
    good = df.filter("b = 'p'")
    assert quality.model_violations(good, TESTS, quality.model_profile(good, TESTS).first()) == []
    none = quality.model_profile(df.limit(0), TESTS).first()
    assert none["rows"] == 0 and quality.model_violations(df, TESTS, none) == []


def test_model_profile_scans_once(spark, sf_dir):
    text = plan(quality.model_profile(given.fact(spark, sf_dir), layers.FACT_TESTS))
    assert text.count("FileScan") == 1


def test_check_models_names_what_fails(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    base = given.base_incidents(spark, sf_dir).limit(20)
    twice = base.unionByName(base.limit(1))
    lake.bronze.replace(twice)
    layers.build_silver(lake)
    layers.build_models(lake)
    with pytest.raises(QualityError, match="Repeated incident_report_number"):
        layers.check_models(lake)
    lake.bronze.replace(base)
    layers.build_silver(lake)
    layers.build_models(lake)
    layers.check_models(lake)
    lake.trends.replace(lake.trends.read().drop("occ_year").limit(1))
    with pytest.raises(QualityError, match="Totals differ"):
        layers.check_models(lake)
