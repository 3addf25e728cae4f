"""Declared schemas of landed records, manifests and control tables.

Reading with a declared schema keeps a batch from changing the shape of the
base table: columns missing from a batch are NULL, and no inference pass reads
the files twice.
"""

from pyspark.sql import types as T

from siltstone import values as V


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


BUSINESS_COLUMNS = (
    "crime_type",
    "category_description",
    "ucr_category",
    "ucr_code",
    "occ_date",
    "occ_date_time",
    "rep_date",
    "rep_date_time",
    "clearance_date",
    "clearance_status",
    "family_violence",
    "council_district",
    "district",
    "sector",
    "census_block_group",
    "location_type",
)

RAW_INCIDENT = T.StructType(
    _strings(*V.SYSTEM_COLUMNS, V.BUSINESS_KEY, *BUSINESS_COLUMNS)
)

RAW_KEYS = T.StructType(_strings(":id", ":updated_at", V.BUSINESS_KEY))

BASE_INCIDENT = T.StructType(
    _strings(*V.SYSTEM_COLUMNS.values(), V.BUSINESS_KEY, *BUSINESS_COLUMNS)
    + _strings("dataset_id", "ingestion_run_id")
    + [T.StructField("ingested_at", T.TimestampType())]
    + _strings("source_file")
)

PAGE_ENTRY = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
    ]
)

MANIFEST = T.StructType(
    _strings(
        "pipeline_run_id",
        "extract_batch_id",
        "run_id",
        "run_type",
        "load_mode",
        "dataset_id",
        "source_url",
        "started_at",
        "completed_at",
        "watermark_start",
        "window_end",
    )
    + [
        T.StructField("page_size", T.LongType()),
        T.StructField("expected_record_count", T.LongType()),
        T.StructField("source_record_count", T.LongType()),
        T.StructField("extracted_record_count", T.LongType()),
        T.StructField("pages_downloaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("files", T.ArrayType(PAGE_ENTRY)),
    ]
)

PIPELINE_RUN = T.StructType(
    _strings("pipeline_run_id", "pipeline_name", "run_type", "status")
    + [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
    + _strings("failure_category", "error_message")
    + [T.StructField("created_at", T.TimestampType())]
)

EXTRACT_BATCH = T.StructType(
    _strings(
        "extract_batch_id", "pipeline_run_id", "dataset_id", "source_url", "status"
    )
    + [
        T.StructField("page_size", T.IntegerType()),
        T.StructField("pages_downloaded", T.IntegerType()),
        T.StructField("record_count", T.LongType()),
    ]
    + _strings("raw_prefix", "manifest_path")
    + [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

FILE_LEDGER = T.StructType(
    _strings("extract_batch_id", "file_name", "object_path")
    + [
        T.StructField("record_count", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("checksum_sha256", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

WATERMARK = T.StructType(
    _strings("dataset_id", "watermark_column")
    + [T.StructField("watermark_value", T.TimestampType())]
    + _strings("last_successful_pipeline_run_id")
    + [T.StructField("updated_at", T.TimestampType())]
)

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("bucket_key", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("source_version", T.LongType()),
    ]
)

# One row a commit without a part, and one for each part that the version has.
PART_COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("parts_replaced", T.LongType()),
        T.StructField("layout", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("source_version", T.LongType()),
    ]
)
