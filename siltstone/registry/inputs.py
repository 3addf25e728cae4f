"""The given tables seen as incidents, batches, snapshots and control tables.

Every view spans its whole table. Odd values (bad dates, blanks, other cases) are
derived from the keys, so the SQL twins can derive them as well.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators.marts import monthly_summary, monthly_trends
from siltstone.operators.staging import stage_batch
from siltstone.operators.standardize import enrich, incident_fact, standardize
from siltstone.session import shared_dir

RUN_ID = "run-1"
DATASET_ID = "incidents"
SOURCE_PREFIX = "landing/run-1/"
INGESTED_AT = datetime(2002, 1, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/siltstone/{purpose}-{uuid.uuid4().hex}"


def _text(number: Column) -> Column:
    return number.cast("string")


def _day_text(day: Column) -> Column:
    return F.date_format(day, V.DATE_TEXT)


def _instant_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _plus(moment: Column, days: Column) -> Column:
    return moment + F.make_dt_interval(days=days.cast("int"))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed incident records, all text."""
    orders = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    reported = _plus(day, key % 9 - 1)
    district = _text(customer % 10 + 1)
    fields = {
        ":id": F.concat(F.lit("row-"), _text(key)),
        ":version": F.lit("1"),
        ":created_at": _instant_text(day),
        ":updated_at": _instant_text(day + F.expr("INTERVAL 12 HOURS")),
        "incident_report_number": _text(key),
        "crime_type": F.when(
            customer % 13 != 0,
            F.concat("o_orderpriority", F.lit("/"), _text(customer % 4)),
        ),
        "category_description": F.col("o_orderpriority"),
        "ucr_category": status,
        "ucr_code": _text(customer % 30),
        "occ_date": F.when(key % 89 == 5, "n/a").otherwise(_day_text(day)),
        "occ_date_time": F.when(key % 97 == 0, "bad").otherwise(
            F.concat(F.lit(" "), F.date_format(day, "MM/dd/yyyy"), F.lit("  05:07 "))
        ),
        "rep_date": _day_text(reported),
        "rep_date_time": F.when(key % 7 == 0, F.lit("8/1/2026 5:07")).otherwise(
            F.date_format(reported, "MM/dd/yyyy HH:mm")
        ),
        "clearance_date": F.when(
            status == "F", _day_text(_plus(reported, key % 40 - 2))
        ),
        "clearance_status": F.when(
            status == "F", F.when(key % 5 == 0, "o").otherwise(" c ")
        ).when(status == "O", "N"),
        "family_violence": F.when(customer % 7 == 0, " y ")
        .when(customer % 7 == 2, "?")
        .when(customer % 7 != 1, "N"),
        "council_district": F.when(customer % 11 == 0, None)
        .when(key % 97 == 0, "x")
        .when(key % 3 == 0, F.concat(district, F.lit(".0")))
        .otherwise(district),
        "district": F.concat(F.lit("D"), _text(customer % 5)),
        "sector": F.concat(F.lit("S"), _text(customer % 8)),
        "census_block_group": _text(customer),
        "location_type": F.when(customer % 17 != 0, "STREET"),
    }
    return orders.select(*[column.alias(name) for name, column in fields.items()])


def base_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_batch(
        raw_incidents(spark, sf_dir),
        dataset_id=DATASET_ID,
        run_id=RUN_ID,
        ingested_at=INGESTED_AT,
        source_prefix=SOURCE_PREFIX,
    )


def clean_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(base_incidents(spark, sf_dir))


def as_fact(clean: DataFrame) -> DataFrame:
    return incident_fact(enrich(clean))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_fact(clean_incidents(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_summary(clean_incidents(spark, sf_dir))


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_trends(fact(spark, sf_dir))


def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a batch that repeats its keys; some keys are NULL or blank."""
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 103 == 1, "  ")
        .when(key % 101 != 1, _text(key))
        .alias(V.BUSINESS_KEY),
        F.when(
            F.col("l_suppkey") % 10 != 0,
            _instant_text(F.col("l_shipdate")),
        ).alias(V.UPDATED_AT),
        _text(F.col("l_partkey") % 12).alias(V.VERSION),
        F.when(
            F.col("l_quantity") != 13,
            F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber"),
        ).alias(V.ROW_ID),
    )


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the stored table of a merge; some times are unknown."""
    return base_incidents(spark, sf_dir).select(
        V.BUSINESS_KEY,
        F.when(
            F.col("census_block_group").cast("long") % 19 != 0, F.col(V.UPDATED_AT)
        ).alias(V.UPDATED_AT),
        V.VERSION,
        "crime_type",
        "ingestion_run_id",
    )


def merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a batch of updates with newer, equal, older and unknown keys."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    shift = F.when(key % 4 == 0, 1).when(key % 4 == 3, -1).otherwise(0)
    moment = _plus(F.col("o_orderdate"), shift) + F.expr("INTERVAL 12 HOURS")
    return table(spark, sf_dir, "orders").select(
        _text(F.when(customer % 11 == 3, key + 1_000_000_000_000).otherwise(key)).alias(
            V.BUSINESS_KEY
        ),
        _instant_text(moment).alias(V.UPDATED_AT),
        F.when(key % 8 == 1, None)
        .when(key % 4 == 1, F.lit("2"))
        .otherwise(F.lit("1"))
        .alias(V.VERSION),
        F.concat(F.lit("UPDATED "), F.col("o_orderpriority")).alias("crime_type"),
        F.lit("run-2").alias("ingestion_run_id"),
    )


def moved_batch(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Updates that move incidents to other months, years, districts and states.

    The first batch loses some dates, the second adds copies under new keys; both
    hold the keys that 35 numbers have in common, and the second one wins there.
    """
    base = base_incidents(spark, sf_dir)
    key = F.col(V.BUSINESS_KEY).cast("long")
    first = F.to_date(F.substring("source_created_at", 1, 10))

    def moved(days: int) -> Column:
        return _day_text(F.date_add(first, days).cast("timestamp"))

    newer = _instant_text(
        _plus(F.to_timestamp(F.substring("source_created_at", 1, 10)), F.lit(number))
        + F.expr("INTERVAL 12 HOURS")
    )
    marked = base.withColumns(
        {V.UPDATED_AT: newer, "ingestion_run_id": F.lit(f"run-{number + 1}")}
    )
    if number == 1:
        return marked.filter(key % 5 == 1).withColumns(
            {
                "occ_date": F.when(key % 35 == 1, "n/a").otherwise(moved(40)),
                "council_district": F.when(key % 2 == 1, "3").otherwise(
                    F.col("council_district")
                ),
                "clearance_status": F.when(key % 3 == 1, "N").otherwise(
                    F.col("clearance_status")
                ),
                "family_violence": F.lit("Y"),
            }
        )
    changed = marked.filter(key % 7 == 2).withColumns(
        {
            "occ_date": moved(-400),
            "clearance_status": F.when(key % 2 == 0, "C"),
        }
    )
    copies = marked.filter(key % 50 == 4).withColumn(
        V.BUSINESS_KEY, _text(key + 1_000_000_000_000)
    )
    return changed.unionByName(copies)


def later_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A republished snapshot: new keys, lost keys, changed values and system fields."""
    base = base_incidents(spark, sf_dir)
    key = F.col(V.BUSINESS_KEY).cast("long")
    return base.withColumns(
        {
            V.BUSINESS_KEY: _text(
                F.when(key % 23 == 4, key + 1_000_000_000_000).otherwise(key)
            ),
            "crime_type": F.when(key % 5 == 2, None).otherwise(F.col("crime_type")),
            "sector": F.when(key % 29 == 0, "moved").otherwise(F.col("sector")),
            V.VERSION: F.when(key % 2 == 0, "2").otherwise(F.col(V.VERSION)),
        }
    )


def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key snapshot of the source: one row per order."""
    return table(spark, sf_dir, "orders").select(
        _text(F.col("o_orderkey")).alias(V.BUSINESS_KEY),
        F.col("o_orderdate").alias(V.UPDATED_AT),
    )


def table_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the table: some differ, some times differ or are unknown."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        _text(F.when(customer % 31 == 1, key + 1_000_000_000_000).otherwise(key)).alias(
            V.BUSINESS_KEY
        ),
        F.when(customer % 37 == 2, None)
        .when(customer % 7 == 3, _plus(F.col("o_orderdate"), F.lit(1)))
        .otherwise(F.col("o_orderdate"))
        .alias(V.UPDATED_AT),
    )


def event_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as source rows of one dataset per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset_id"), "event_id", "ts"
    )


def event_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as the watermark table of the event datasets."""
    region = F.col("r_regionkey")
    names = {0: "signup", 1: "purchase", 2: "view", 3: "error", 4: "click"}
    marks = {0: "2023-12-31", 1: "2024-02-01", 2: "2024-01-04", 3: "2024-01-20"}

    def choose(options: dict[int, str]) -> Column:
        chosen = F.lit(None).cast("string")
        for number, text in options.items():
            chosen = F.when(region == number, text).otherwise(chosen)
        return chosen

    return table(spark, sf_dir, "region").select(
        choose(names).alias("dataset_id"),
        choose(marks).cast("timestamp_ntz").alias("watermark_value"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pipeline runs."""
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    started = F.when(customer % 29 != 0, F.col("o_orderdate").cast("timestamp"))
    took = F.make_dt_interval(secs=(customer * 1.5).cast("decimal(18,6)"))
    failed = status == "F"
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), _text(F.col("o_orderkey"))).alias("pipeline_run_id"),
        F.lit("incident_load").alias("pipeline_name"),
        F.when(customer % 9 == 0, V.FULL_SNAPSHOT)
        .otherwise(V.INCREMENTAL)
        .alias("run_type"),
        F.when(failed, V.FAILED)
        .when(status == "O", V.SUCCESS)
        .otherwise(V.RUNNING)
        .alias("status"),
        started.alias("started_at"),
        F.when(status != "P", started + took).alias("finished_at"),
        F.when(failed, V.UNKNOWN_ERROR).alias("failure_category"),
        F.when(failed, F.col("o_orderpriority")).alias("error_message"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as extraction batches of the runs."""
    shipped = F.col("l_shipdate").cast("timestamp")
    identity = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        identity.alias("extract_batch_id"),
        F.concat(F.lit("run-"), _text(F.col("l_orderkey"))).alias("pipeline_run_id"),
        F.concat(F.lit("ds-"), _text(F.col("l_suppkey"))).alias("dataset_id"),
        F.lit("source").alias("source_url"),
        F.when(F.col("l_linestatus") == "F", V.FAILED)
        .otherwise(V.SUCCESS)
        .alias("status"),
        F.lit(V.PAGE_SIZE).alias("page_size"),
        F.col("l_linenumber").alias("pages_downloaded"),
        F.col("l_partkey").alias("record_count"),
        identity.alias("raw_prefix"),
        F.when(F.col("l_linestatus") == "O", identity).alias("manifest_path"),
        shipped.alias("started_at"),
        shipped.alias("finished_at"),
        shipped.alias("created_at"),
    )


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the watermark table of the batch datasets."""
    key = F.col("s_suppkey")
    year = F.when(key % 2 == 0, "1997-01-01").otherwise("2000-06-01")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("ds-"), _text(key)).alias("dataset_id"),
        F.lit("updated_at").alias("watermark_column"),
        F.when(key % 9 != 0, year).cast("timestamp").alias("watermark_value"),
        F.concat(F.lit("run-"), _text(key * 3)).alias("last_successful_pipeline_run_id"),
        F.lit("2002-01-01").cast("timestamp").alias("updated_at"),
    )


def finish_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as requests to finish their run, some for unknown runs or datasets."""
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    own = F.when(F.col("l_partkey") % 3 == 0, supplier * 3).otherwise(order)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.lit("run-"),
            _text(F.when(order % 41 == 1, order + 1_000_000_000_000).otherwise(own)),
        ).alias("pipeline_run_id"),
        F.concat(
            F.lit("ds-"),
            _text(F.when(order % 43 == 1, F.lit(-1)).otherwise(supplier)),
        ).alias("dataset_id"),
        F.col("l_shipdate").cast("timestamp").alias("window_end"),
    )


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as registered page files."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("batch-"), _text(F.col("o_custkey"))).alias("extract_batch_id"),
        F.lit("part_0001.json").alias("file_name"),
        F.concat(F.lit("landing/"), _text(F.col("o_orderkey"))).alias("object_path"),
        F.lit(V.PAGE_SIZE).cast("long").alias("record_count"),
        (F.col("o_orderkey") % 1000).alias("file_size_bytes"),
        F.lit(None).cast("string").alias("checksum_sha256"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def uploaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files to register: known objects with new counts, and new objects."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    moved = F.when(order % 6 == 0, order + 1_000_000_000_000).otherwise(order)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("batch-"), _text(customer)).alias("extract_batch_id"),
        F.lit("part_0002.json").alias("file_name"),
        F.concat(F.lit("landing/"), _text(moved)).alias("object_path"),
        (customer % 500).alias("record_count"),
        (customer * 100).alias("file_size_bytes"),
        F.lit(None).cast("string").alias("checksum_sha256"),
        F.lit("2002-01-01").cast("timestamp").alias("created_at"),
    )
