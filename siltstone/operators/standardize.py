"""Typed standardization, enrichment and the incident fact."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import parsing
from siltstone.functions.measures import days_forward
from siltstone.functions.predicates import holds

FACT_COLUMNS = (
    "incident_report_number",
    "source_row_id",
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
    "is_cleared",
    "is_family_violence",
    "council_district",
    "district",
    "sector",
    "census_block_group",
    "location_type",
    "reporting_delay_days",
    "clearance_delay_days",
    "has_date_sequence_issue",
    "incident_count",
    "dataset_id",
    "ingestion_run_id",
    "ingested_at",
    "source_created_at",
    "source_updated_at",
)


def standardize(base: DataFrame) -> DataFrame:
    """Source text to dates, times, flags and numbers; a narrow projection."""
    status = parsing.upper_trimmed(F.col("clearance_status"))
    return base.withColumns(
        {
            "occ_date": parsing.parse_date(F.col("occ_date")),
            "occ_date_time": parsing.parse_local_time(F.col("occ_date_time")),
            "rep_date": parsing.parse_date(F.col("rep_date")),
            "rep_date_time": parsing.parse_local_time(F.col("rep_date_time")),
            "clearance_date": parsing.parse_date(F.col("clearance_date")),
            "source_created_at": parsing.parse_instant(F.col("source_created_at")),
            "source_updated_at": parsing.parse_instant(F.col("source_updated_at")),
            "is_family_violence": parsing.yes_no(F.col("family_violence")),
            "clearance_status": status,
            "is_cleared": parsing.cleared_flag(status),
            "council_district": parsing.parse_whole_number(F.col("council_district")),
        }
    ).drop("family_violence")


def enrich(clean: DataFrame) -> DataFrame:
    """Reporting and clearance delays, and a flag for dates out of sequence."""
    occurred, reported, cleared = (
        F.col(c) for c in ("occ_date", "rep_date", "clearance_date")
    )
    return clean.select(
        "*",
        days_forward(occurred, reported).alias("reporting_delay_days"),
        days_forward(reported, cleared).alias("clearance_delay_days"),
        (
            holds(reported < occurred)
            | holds(cleared < occurred)
            | holds(cleared < reported)
        ).alias("has_date_sequence_issue"),
    )


def incident_fact(enriched: DataFrame) -> DataFrame:
    """One row per incident with the additive measure ``incident_count``."""
    return enriched.withColumn("incident_count", F.lit(1)).select(*FACT_COLUMNS)
