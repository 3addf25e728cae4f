"""Monthly aggregates.

Groups are month by category by district, few beside the rows, so partial
aggregation in the map tasks absorbs any hot group before the shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.measures import month_of, ratio

TREND_MEASURES = (
    "incident_count",
    "known_clearance_count",
    "cleared_count",
    "family_violence_count",
)


def monthly_summary(clean: DataFrame) -> DataFrame:
    """Incidents per month, type and district; missing values form groups too."""
    return clean.groupBy(
        month_of(F.col("occ_date")).alias("occ_month"), "crime_type", "council_district"
    ).agg(
        F.count(F.lit(1)).alias("incident_count"),
        F.count_if(F.col("is_cleared").isNotNull()).alias("known_clearance_count"),
        F.count_if(F.col("is_cleared")).alias("cleared_count"),
        F.count_if(F.col("is_family_violence")).alias("family_violence_count"),
    )


def monthly_trends(fact: DataFrame) -> DataFrame:
    """The same mart built from the fact in SQL, as a second opinion on it."""
    return fact.sparkSession.sql(
        """
        SELECT
          CAST(date_trunc('MONTH', occ_date) AS DATE) AS occ_month,
          crime_type,
          council_district,
          sum(incident_count) AS incident_count,
          sum(CASE WHEN is_cleared IS NOT NULL THEN 1 ELSE 0 END)
            AS known_clearance_count,
          sum(CASE WHEN is_cleared THEN 1 ELSE 0 END) AS cleared_count,
          sum(CASE WHEN is_family_violence THEN 1 ELSE 0 END)
            AS family_violence_count
        FROM {fact}
        GROUP BY ALL
        """,
        fact=fact,
    )


def clearance_rates(fact: DataFrame) -> DataFrame:
    """Clearance counts and rate per month and district."""
    cleared = F.col("is_cleared")
    return (
        fact.groupBy(month_of(F.col("occ_date")).alias("occ_month"), "council_district")
        .agg(
            F.sum("incident_count").alias("incident_count"),
            F.count_if(cleared.isNotNull()).alias("known_clearance_count"),
            F.count_if(cleared).alias("cleared_count"),
            F.count_if(~cleared).alias("not_cleared_count"),
            F.count_if(cleared.isNull()).alias("unknown_clearance_count"),
        )
        .select(
            "*",
            ratio(F.col("cleared_count"), F.col("known_clearance_count")).alias(
                "clearance_rate"
            ),
        )
    )


def control_totals(summary: DataFrame) -> DataFrame:
    """Row count and column totals of the monthly summary."""
    return summary.agg(
        F.count(F.lit(1)).alias("gold_row_count"),
        F.sum("incident_count").alias("total_incidents"),
        F.sum("known_clearance_count").alias("total_known_clearance"),
        F.sum("cleared_count").alias("total_cleared"),
        F.sum("family_violence_count").alias("total_family_violence"),
    )


def latest_months(summary: DataFrame, rows: int) -> DataFrame:
    """Newest months first, largest groups first within a month."""
    return summary.orderBy(
        F.desc("occ_month"),
        F.desc("incident_count"),
        "crime_type",
        "council_district",
    ).limit(rows)
