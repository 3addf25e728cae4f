"""From landed records to a checked, deduplicated batch."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.parsing import instant_of, parse_whole_number
from siltstone.functions.predicates import blank


def stage_batch(
    raw: DataFrame,
    *,
    dataset_id: str,
    run_id: str,
    ingested_at: datetime,
    source_prefix: str,
) -> DataFrame:
    """System columns renamed, ingestion columns added."""
    return raw.withColumnsRenamed(V.SYSTEM_COLUMNS).withColumns(
        {
            "dataset_id": F.lit(dataset_id),
            "ingestion_run_id": F.lit(run_id),
            "ingested_at": F.lit(ingested_at),
            "source_file": F.lit(source_prefix),
        }
    )


def recency(
    df: DataFrame,
    updated_at: str = V.UPDATED_AT,
    version: str = V.VERSION,
    row_id: str = V.ROW_ID,
) -> list[Column]:
    """Newest first: update time, then version as a number, then row id."""
    return [
        instant_of(df, updated_at).desc_nulls_last(),
        parse_whole_number(F.col(version).cast("string"), "bigint").desc_nulls_last(),
        F.col(row_id).desc_nulls_last(),
    ]


def dedupe_latest(
    df: DataFrame, key: str = V.BUSINESS_KEY, newest_first: list[Column] | None = None
) -> DataFrame:
    """One row per key, the first in the given order.

    Kept in the ``row_number() == 1`` form: Spark then keeps one row per key in
    every map task before the shuffle, so a key holding much of the data does not
    travel to one task.
    """
    order = recency(df) if newest_first is None else newest_first
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def batch_profile(
    df: DataFrame,
    key: str = V.BUSINESS_KEY,
    row_id: str = V.ROW_ID,
    updated_at: str = V.UPDATED_AT,
) -> DataFrame:
    """Every count the batch gates need, from one pass.

    A NULL key is one group of the deduplication, so it counts as one kept row.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("incoming_count"),
        (
            F.count_distinct(key)
            + F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0))
        ).alias("deduplicated_count"),
        F.count_if(blank(F.col(key))).alias("missing_key_count"),
        F.count_if(blank(F.col(row_id))).alias("missing_row_id_count"),
        F.count_if(F.col(updated_at).isNull()).alias("missing_updated_at_count"),
    )
    removed = F.col("incoming_count") - F.col("deduplicated_count")
    return counted.withColumn("duplicates_removed", removed)


def missing_keys(
    df: DataFrame,
    key: str = V.BUSINESS_KEY,
    row_id: str = V.ROW_ID,
    updated_at: str = V.UPDATED_AT,
) -> DataFrame:
    """Rows that lack a key, a row id or an update time."""
    return df.filter(
        blank(F.col(key)) | blank(F.col(row_id)) | F.col(updated_at).isNull()
    )


def unparsable_times(df: DataFrame, updated_at: str = V.UPDATED_AT) -> DataFrame:
    """Rows whose update time is there but is not an instant."""
    return df.filter(F.col(updated_at).isNotNull() & instant_of(df, updated_at).isNull())


def batch_problems(profile: DataFrame, full_snapshot: bool) -> DataFrame:
    """The failed gates of a batch profile, one row each; empty when all passed."""
    one_per_key = F.lit(full_snapshot) & (F.col("duplicates_removed") > 0)
    gates = {
        "The batch holds no records.": F.col("incoming_count") == 0,
        "Records without a business key.": F.col("missing_key_count") > 0,
        "Records without a source row id.": F.col("missing_row_id_count") > 0,
        "Records without an update time.": F.col("missing_updated_at_count") > 0,
        "A full snapshot must hold one record per key.": one_per_key,
    }
    failed = F.array(*[F.when(bad, F.lit(text)) for text, bad in gates.items()])
    return profile.select(F.explode(F.array_compact(failed)).alias("problem"))
