"""Plans that hold on big data, and results with a hot key."""

import re
from datetime import date

from compare import plan, rows
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone import values as V
from siltstone.operators import control, merge, profile, reconcile, staging
from siltstone.operators.skew import heavy_keys, is_heavy, lookup
from siltstone.registry import inputs as given
from siltstone.registry.queries import QUERIES
from siltstone.sources import changes, landing
from siltstone.sources.tables import VersionedTable, partition_stats, with_year_range

KEY = V.BUSINESS_KEY


def test_dedupe_limits_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedupe_latest"](spark, sf_dir))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before
    assert "row_number(), 1, Partial" in after


def test_typed_layer_stays_compiled(spark, sf_dir, capsys):
    """Methods over 8000 bytes of code are interpreted row by row."""
    given.clean_incidents(spark, sf_dir).explain("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
    assert sizes and max(map(int, sizes)) < 8000


def test_reconciliation_shuffles_once(spark, sf_dir):
    text = plan(QUERIES["reconcile_summary"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_bag_difference_shuffles_once(spark, sf_dir):
    text = plan(QUERIES["bag_diff"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


def test_small_updates_do_not_shuffle_the_target(spark, sf_dir, no_auto_broadcast):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_shipdate").alias("t"),
        F.col("l_linenumber").alias("v"),
    )
    updates = lines.limit(5)
    merged = merge.upsert(lines, updates, "k", "t", "v", small_updates=True)
    text = plan(merged)
    rewritten = text[: text.index("BroadcastExchange")]
    assert "BroadcastHashJoin [k" in rewritten
    assert "Exchange hashpartitioning" not in rewritten


def test_bucketed_target_is_never_shuffled(spark, tmp_path, no_auto_broadcast):
    target = spark.range(1000).selectExpr("cast(id AS string) k", "id t", "'1' v")
    updates = spark.range(500, 1500).selectExpr("cast(id AS string) k", "id + id % 2 t", "'1' v")
    table = VersionedTable(spark, str(tmp_path / "t"), bucket_key="k", buckets=4)
    table.replace(target)
    merged = merge.upsert(table.read(), updates, "k", "t", "v")
    assert plan(merged).count("Exchange hashpartitioning") == 1
    assert table.replace(merged, keeps_buckets=True) == 1500
    assert len(table.read().inputFiles()) == 4
    unapplied = merge.unapplied_rows(updates, table.read(), "k", "t", "v")
    assert plan(unapplied).count("Exchange hashpartitioning") == 1
    assert unapplied.isEmpty()
    plain = merge.upsert(target, updates, "k", "t", "v")
    assert rows(table.read()) == rows(plain)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(changes.change_window(events, date(2024, 1, 10), "ts"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in text
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_year_filter_prunes_partitions(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    table = VersionedTable(spark, str(tmp_path / "orders"))
    dated = orders.withColumn("day", F.to_date("o_orderdate"))
    assert table.replace(dated, year_of="day", year_column="year") == orders.count()
    first, last = date(1996, 3, 1), date(1997, 2, 1)
    ranged = with_year_range(table.read(), "day", "year", first, last)
    assert "PartitionFilters: [isnotnull(year" in plan(ranged)
    read = {name.split("year=")[1][:4] for name in ranged.inputFiles()}
    assert read >= {"1996", "1997"}
    assert ranged.count() == dated.filter(F.col("day").between(first, last)).count()
    stats = partition_stats(table.read(), "year")
    assert stats.agg(F.sum("record_count")).first()[0] == orders.count()


def hot(spark, total=3000):
    """A third of the rows share one key, another third has none."""
    number = F.col("id")
    return spark.range(total, numPartitions=6).select(
        F.when(number % 3 == 0, "hot").when(number % 3 == 1, number.cast("string")).alias(KEY),
        F.lit("2026-08-01T12:00:00.000Z").alias(V.UPDATED_AT),
        number.cast("string").alias(V.VERSION),
        F.format_string("row-%06d", number).alias(V.ROW_ID),
    )


def test_hot_and_missing_keys_are_exact(spark):
    df = hot(spark)
    kept = staging.dedupe_latest(df)
    assert kept.count() == 1002
    newest = rows(kept.filter(f"{KEY} = 'hot'").select(V.VERSION))
    assert newest == [("2997",)]
    counts = staging.batch_profile(df).first()
    assert counts["deduplicated_count"] == 1002
    assert rows(profile.duplicate_keys(df)) == [("hot", 1000)]
    summary = reconcile.reconcile_summary(reconcile.key_states(df, kept)).first()
    assert summary["missing_from_target"] == 1000
    assert summary["source_repeated_keys"] == 1
    assert summary["timestamp_mismatches"] == 0


def half_hot(spark):
    """Half the rows hold one key, a tenth none, the others a key of their own."""
    number = F.col("id")
    return spark.range(4000, numPartitions=4).select(
        F.when(number % 2 == 0, "hot").when(number % 10 != 1, number.cast("string")).alias(KEY),
        number.alias("v"),
    )


def test_heavy_keys_are_measured(spark):
    df = half_hot(spark)
    found = heavy_keys(df, KEY, "v", share=0.01)
    assert found == {KEY: ["hot", None], "v": []}
    assert df.filter(is_heavy(KEY, found[KEY])).count() == 2400
    assert df.filter(is_heavy(KEY, ["hot"])).count() == 2000
    assert df.filter(~is_heavy(KEY, [])).count() == 4000
    assert heavy_keys(df.limit(0), KEY) == {KEY: []}


def test_lookup_is_a_left_join_without_copies(spark, no_auto_broadcast):
    df = half_hot(spark)
    names = spark.createDataFrame([("hot", 1), ("7", 2), ("unused", 3)], f"{KEY} string, n int")
    plain = df.join(names, KEY, "left")
    for heavy in (None, [], ["hot"], ["hot", None], [None]):
        found = lookup(df, names, KEY, heavy)
        assert rows(found.select(plain.columns)) == rows(plain)
    text = plan(lookup(df, names, KEY))
    assert "Generate" not in text and "explode" not in text
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1


def test_a_run_with_half_of_the_batches(spark, no_auto_broadcast):
    number = F.col("id")
    empty = {f.name: F.lit(None).cast(f.dataType) for f in schemas.EXTRACT_BATCH}
    batches = spark.range(2000).select(
        *[
            column.alias(name)
            for name, column in {
                **empty,
                "extract_batch_id": number.cast("string"),
                "pipeline_run_id": F.when(number % 2 == 0, "hot").otherwise(
                    (number % 700).cast("string")
                ),
                "dataset_id": F.when(number % 3 == 0, "big").otherwise("d"),
            }.items()
        ]
    )
    empty = {f.name: F.lit(None).cast(f.dataType) for f in schemas.PIPELINE_RUN}
    runs = spark.range(600).select(
        *[
            column.alias(name)
            for name, column in {
                **empty,
                "pipeline_run_id": F.when(number == 0, "hot").otherwise(
                    number.cast("string")
                ),
            }.items()
        ]
    )
    marks = spark.createDataFrame([("big", "c", None, "hot", None)], schemas.WATERMARK)
    found = control.run_summary(runs, batches, marks)
    plainly = control.run_summary(runs, batches, marks, heavy=control.NONE_HEAVY)
    assert rows(found.select("pipeline_run_id", "extract_batch_id", "watermark_column")) == rows(
        plainly.select("pipeline_run_id", "extract_batch_id", "watermark_column")
    )
    of_hot = found.filter("pipeline_run_id = 'hot'")
    assert of_hot.count() == 1000
    assert of_hot.filter("is_last_successful_run").count() == 334
    text = plan(found)
    assert "Generate" not in text and "BroadcastHashJoin" in text


def test_load_modes_with_a_hot_dataset(spark):
    source = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise((F.col("id") % 50).cast("string")).alias("d"),
        F.col("id").alias("t"),
    )
    marks = source.select("d").distinct().withColumn("watermark_value", F.lit(2899))
    modes = control.load_modes(source, marks, "d", "t")
    big = modes.filter("d = 'big'").first()
    assert (big["source_record_count"], big["changed_record_count"]) == (1000, 33)
    assert big["window_end"] == 2997
    assert modes.agg(F.sum("changed_record_count")).first()[0] == 100


def test_pages_split_rows_of_one_timestamp(spark, tmp_path):
    same = spark.range(1000).select(F.lit("t").alias("ts"), F.col("id").alias("id"))
    numbered = changes.number_pages(same, ["ts", "id"], page_size=64)
    wrong = numbered.filter(F.col("page_number") != F.floor(F.col("id") / 64) + 1)
    assert wrong.isEmpty()
    assert changes.read_page(numbered, 16).count() == 1000 - 15 * 64
    prefix = str(tmp_path / "pages")
    landing.write_pages(same, prefix, ["ts", "id"], page_size=64)
    pages = landing.page_inventory(
        landing.scan_batch(spark, prefix, same.schema, json_lines=True)
    )
    assert pages.agg(F.sum("record_count"), F.max("record_count")).first()[0] == 1000
    assert pages.filter("record_count > 64").isEmpty()


def test_keyset_pages_cover_the_source(spark):
    source = spark.range(25).select((F.col("id") * 3).alias("k"))
    seen, after = [], None
    while True:
        page = [row["k"] for row in changes.keyset_page(source, F.col("k"), after, 10).collect()]
        seen += page
        if len(page) < 10:
            break
        after = page[-1]
    assert seen == [3 * i for i in range(25)]


def test_broadcast_bounds(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert merge.fits_broadcast(df)
    assert not merge.fits_broadcast(df, max_rows=99)
    assert not merge.fits_broadcast(df, max_bytes=50_000)
    assert merge.fits_broadcast(df.limit(0))
