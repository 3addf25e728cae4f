"""Profiling reports over the base table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.measures import missing
from siltstone.functions.predicates import blank

DATE_COLUMNS = (
    "occ_date",
    "occ_date_time",
    "rep_date",
    "rep_date_time",
    "clearance_date",
    "source_created_at",
    "source_updated_at",
)


def key_profile(
    base: DataFrame, row_id: str = V.ROW_ID, key: str = V.BUSINESS_KEY
) -> DataFrame:
    """Record, distinct and missing counts of both identities in one scan."""
    return base.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct(row_id).alias(f"distinct_{row_id}s"),
        F.count_if(blank(F.col(row_id))).alias(f"missing_{row_id}s"),
        F.count_distinct(key).alias(f"distinct_{key}s"),
        F.count_if(blank(F.col(key))).alias(f"missing_{key}s"),
    )


def duplicate_keys(
    base: DataFrame, key: str = V.BUSINESS_KEY, rows: int | None = V.PROFILE_ROWS
) -> DataFrame:
    """The most repeated keys; all of them when ``rows`` is None."""
    repeated = (
        base.filter(~blank(F.col(key)))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter("record_count > 1")
        .orderBy(F.desc("record_count"), key)
    )
    return repeated if rows is None else repeated.limit(rows)


def date_coverage(
    base: DataFrame,
    ranged: Sequence[str] = ("occ_date", "rep_date"),
    counted: Sequence[str] = (
        "clearance_date",
        "source_created_at",
        "source_updated_at",
    ),
) -> DataFrame:
    """First and last value of the ranged columns, missing counts of all."""
    measures = []
    for name in ranged:
        measures += [
            F.min(name).alias(f"earliest_{name}"),
            F.max(name).alias(f"latest_{name}"),
            missing(F.col(name)).alias(f"missing_{name}"),
        ]
    measures += [missing(F.col(name)).alias(f"missing_{name}") for name in counted]
    return base.agg(*measures)


def status_breakdown(
    base: DataFrame,
    status: str = "clearance_status",
    dated: str = "clearance_date",
) -> DataFrame:
    """Records per status, with and without the date that belongs to it."""
    return (
        base.groupBy(F.coalesce(status, F.lit(V.MISSING_LABEL)).alias(status))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count(dated).alias(f"records_with_{dated}"),
            missing(F.col(dated)).alias(f"records_without_{dated}"),
        )
        .orderBy(F.desc("record_count"), status)
    )


def value_frequency(base: DataFrame, column: str = "family_violence") -> DataFrame:
    return (
        base.groupBy(F.coalesce(column, F.lit(V.MISSING_LABEL)).alias(column))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), column)
    )


def date_sample(
    base: DataFrame,
    present: str = "clearance_date",
    columns: Sequence[str] = DATE_COLUMNS,
    rows: int = V.PROFILE_ROWS,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A few rows of the date columns; any rows unless an order is given."""
    dated = base.filter(F.col(present).isNotNull())
    if order_by:
        dated = dated.orderBy(*order_by)
    return dated.select(*columns).limit(rows)
