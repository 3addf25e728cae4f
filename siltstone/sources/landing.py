"""Landed batches: pages of records plus one manifest, under a run prefix.

A manifest written here is a header row in one folder and one row per page file in
another, so a batch of many pages needs no single huge record. A manifest that is
one JSON object with all its files nested inside is read as well.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone import values as V

# ``part*`` matches part_0001.json as well as Spark's own part-00000-... names;
# neither matches the manifest.
PAGES_GLOB = "part*.json"
MANIFEST_FOLDER = "manifest"
ENTRIES_FOLDER = "page_entries"


def batch_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{run_id}/"


def scan_batch(
    spark: SparkSession,
    prefix: str,
    schema: T.StructType | None = schemas.RAW_INCIDENT,
    *,
    json_lines: bool = False,
    extra_columns: tuple[str, ...] = (),
) -> DataFrame:
    """All pages of a batch.

    Pages holding one JSON array each are the default; ``json_lines`` reads the
    splittable pages that ``write_pages`` makes. With ``schema=None`` the columns
    are found by reading the batch once more, scalars as text, and declared
    columns that are absent are added as NULL.
    """
    reader = spark.read.option("multiLine", not json_lines)
    path = f"{prefix.rstrip('/')}/{PAGES_GLOB}"
    if schema is not None:
        wanted = T.StructType(list(schema.fields))
        for name in extra_columns:
            wanted = wanted.add(name, T.StringType())
        return reader.schema(wanted).json(path)
    found = reader.option("primitivesAsString", True).json(path)
    absent = [f for f in schemas.RAW_INCIDENT if f.name not in found.columns]
    return found.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def scan_manifest(spark: SparkSession, prefix: str) -> DataFrame:
    """The manifest of a batch as a one-row DataFrame, nested files included.

    Key snapshots state what they landed as ``records_downloaded``.
    """
    other = "records_downloaded"
    layout = T.StructType(list(schemas.MANIFEST.fields)).add(other, T.LongType())
    found = (
        spark.read.schema(layout)
        .option("multiLine", True)
        .json(f"{prefix.rstrip('/')}/{MANIFEST_FOLDER}*")
    )
    landed = F.coalesce("extracted_record_count", other)
    return found.withColumn("extracted_record_count", landed).drop(other)


def scan_entries(spark: SparkSession, prefix: str) -> DataFrame:
    """The listed page files of a batch written by ``write_manifest``."""
    return spark.read.schema(schemas.PAGE_ENTRY).json(
        f"{prefix.rstrip('/')}/{ENTRIES_FOLDER}"
    )


def nested_entries(manifests: DataFrame, run_id: str = "run_id") -> DataFrame:
    """The page files nested in manifests, one row each."""
    return manifests.select(run_id, F.inline("files"))


def write_pages(
    rows: DataFrame, prefix: str, order_by: list[str], page_size: int = V.PAGE_SIZE
) -> None:
    """Write pages of at most ``page_size`` records in global key order.

    Ranges rather than hashes of the order columns are spread over the tasks, so
    rows sharing one timestamp still split as long as the last column differs.
    """
    (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .write.option("maxRecordsPerFile", page_size)
        .option("ignoreNullFields", False)
        .json(prefix)
    )


def page_lines(spark: SparkSession, prefix: str) -> DataFrame:
    """The lines of pages with one record a line, not parsed: enough to count them."""
    return spark.read.text(f"{prefix.rstrip('/')}/{PAGES_GLOB}")


def page_inventory(pages: DataFrame) -> DataFrame:
    """What is on storage: one row per page file with record count and size."""
    return pages.groupBy(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
    ).agg(F.count(F.lit(1)).alias("record_count"))


def page_checksums(spark: SparkSession, files: str) -> DataFrame:
    """Path, size and SHA-256 of the bytes of each file; ``files`` may hold wildcards.

    A file is read as one row, which the page size bounds, and digested where it lies.
    """
    return (
        spark.read.format("binaryFile")
        .load(files)
        .select(
            F.col("path").alias("object_path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("file_size_bytes"),
            F.sha2("content", 256).alias("checksum_sha256"),
        )
    )


def summarize_inventory(inventory: DataFrame) -> DataFrame:
    """One row: pages and records."""
    return inventory.agg(
        F.count(F.lit(1)).alias("pages_downloaded"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("extracted_record_count"),
    )


def extraction_status(
    expected: F.Column, extracted: F.Column, pages: F.Column, max_pages: F.Column
) -> F.Column:
    """SUCCESS on equal counts, PARTIAL when a page cap was hit, else a mismatch."""
    return (
        F.when(extracted == expected, V.SUCCESS)
        .when(max_pages.isNotNull() & (pages >= max_pages), V.PARTIAL)
        .otherwise(V.COUNT_MISMATCH)
    )


def bootstrap_status(
    expected: F.Column, extracted: F.Column, max_pages: F.Column
) -> F.Column:
    """The full-extraction variant, which tests the page cap first."""
    return (
        F.when(max_pages.isNotNull() & (extracted < expected), V.PARTIAL)
        .when(extracted == expected, V.SUCCESS)
        .otherwise(V.COUNT_MISMATCH)
    )


def build_manifest(
    inventory: DataFrame,
    *,
    run: dict[str, str | None],
    expected: int,
    source_records: int,
    page_size: int = V.PAGE_SIZE,
    max_pages: int | None = None,
) -> DataFrame:
    """The manifest header of a landed batch; ``run`` gives its text fields."""
    summary = summarize_inventory(inventory)
    filled = summary.withColumns(
        {
            "page_size": F.lit(page_size).cast("long"),
            "expected_record_count": F.lit(expected).cast("long"),
            "source_record_count": F.lit(source_records).cast("long"),
            "status": extraction_status(
                F.lit(expected),
                F.col("extracted_record_count"),
                F.col("pages_downloaded"),
                F.lit(max_pages).cast("long"),
            ),
        }
    )
    header = [f for f in schemas.MANIFEST if f.name != "files"]
    texts = [
        F.lit(run.get(f.name)).cast("string").alias(f.name)
        for f in header
        if f.name not in filled.columns
    ]
    return filled.select("*", *texts).select(*[f.name for f in header])


def write_manifest(spark: SparkSession, prefix: str, **header) -> None:
    """List the pages under a prefix and sum the list up in a header.

    Written after the pages, the header last: it marks the batch as complete. The
    pages are read once, as lines, and the header is made from the written list.
    ``header`` goes to ``build_manifest``.
    """
    folder = prefix.rstrip("/")
    inventory = page_inventory(page_lines(spark, prefix))
    stated = inventory.select("file_name", "record_count", "file_size_bytes")
    stated.write.json(f"{folder}/{ENTRIES_FOLDER}")
    manifest = build_manifest(scan_entries(spark, prefix), **header)
    manifest.coalesce(1).write.json(f"{folder}/{MANIFEST_FOLDER}")
