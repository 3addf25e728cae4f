"""Queries on a source table: change window, pages, key snapshot, summary."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.parsing import instant_of
from siltstone.functions.predicates import within
from siltstone import values as V
from siltstone.sources.tables import staged


def source_summary(source: DataFrame, updated_at: str = V.UPDATED_AT) -> DataFrame:
    """Record count and latest update time, in one pass."""
    return source.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max(updated_at).alias("max_updated_at"),
    )


def change_window(
    source: DataFrame, watermark, updated_at: str = V.UPDATED_AT
) -> DataFrame:
    """Changed records after the watermark and the end of their window."""
    later = instant_of(source, updated_at) > watermark
    return source_summary(source.filter(later), updated_at)


def window_rows(
    source: DataFrame, watermark, window_end, updated_at: str = V.UPDATED_AT
) -> DataFrame:
    """Rows after the watermark up to the fixed end of the window."""
    return source.filter(within(instant_of(source, updated_at), watermark, window_end))


def number_pages(
    rows: DataFrame, order_by: list[str], page_size: int = V.PAGE_SIZE
) -> DataFrame:
    """Adds ``page_number`` by position in the global order, without one big task.

    The rows are range-partitioned and sorted once and written to the shared
    folder. An id that is unique per partition then gives each row its
    position inside its partition, and the partition sizes (one row per
    partition) give each partition its start.
    """
    ordered = staged(
        rows.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()),
        "pages",
    )
    part = F.shiftrightunsigned("_id", 33)
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            "_part",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        )
    )
    position = F.col("_start") + place
    return (
        ordered.withColumn("_part", part)
        # At most one row per partition of the checkpoint, whatever the data size.
        .join(F.broadcast(starts), "_part")
        .withColumn("page_number", F.call_function("div", position, F.lit(page_size)) + 1)
        .drop("_id", "_part", "_start")
    )


def read_page(pages: DataFrame, number: int) -> DataFrame:
    return pages.filter(F.col("page_number") == number)


def keyset_page(
    source: DataFrame, key: F.Column, after=None, page_size: int = V.PAGE_SIZE
) -> DataFrame:
    """The next ``page_size`` rows whose key is greater than ``after``."""
    rest = source if after is None else source.filter(key > after)
    return rest.orderBy(key).limit(page_size)


def key_snapshot(
    source: DataFrame,
    window_end,
    key: str = V.BUSINESS_KEY,
    row_id: str = V.ROW_ID,
    updated_at: str = V.UPDATED_AT,
) -> DataFrame:
    """Key, row id and update time of every row up to the window end, by key."""
    return (
        source.filter(instant_of(source, updated_at) <= window_end)
        .select(key, row_id, updated_at)
        .orderBy(key)
    )
