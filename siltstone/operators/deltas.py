"""Changes as rows that go and rows that come, and aggregates kept by them.

A change set holds, for every touched key, all rows it had (``old``) and all rows it
has now (``new``). Row-wise layers apply the same function to both sides. Aggregates
of counts and sums add the new side and subtract the old one, so their cost depends
on the change and on the number of groups, not on the table.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.measures import month_of, ratio
from siltstone.operators.marts import TREND_MEASURES

SUMMARY_KEYS = ("occ_month", "crime_type", "council_district")
RATE_KEYS = ("occ_month", "council_district")
RATE_MEASURES = (
    "incident_count",
    "known_clearance_count",
    "cleared_count",
    "not_cleared_count",
    "unknown_clearance_count",
)


@dataclass(frozen=True)
class Changes:
    """Rows of the touched ``keys`` before and after, and the table version before."""

    old: DataFrame
    new: DataFrame
    keys: DataFrame
    base_version: int
    key: str = V.BUSINESS_KEY

    def mapped(self, layer: Callable[[DataFrame], DataFrame]) -> "Changes":
        """The same change in a layer that is made row by row."""
        return replace(self, old=layer(self.old), new=layer(self.new))


def signed(changes: Changes) -> DataFrame:
    """All rows of a change set with ``sign`` 1 for those that come, -1 for the others."""
    return changes.new.withColumn("sign", F.lit(1)).unionByName(
        changes.old.withColumn("sign", F.lit(-1))
    )


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("sign")).otherwise(0))


def summary_delta(changes: Changes) -> DataFrame:
    """What the monthly summary gains and loses, from changes of typed rows."""
    return (
        signed(changes)
        .groupBy(
            month_of(F.col("occ_date")).alias("occ_month"),
            "crime_type",
            "council_district",
        )
        .agg(
            F.sum("sign").alias("incident_count"),
            _sum_if(F.col("is_cleared").isNotNull()).alias("known_clearance_count"),
            _sum_if(F.col("is_cleared")).alias("cleared_count"),
            _sum_if(F.col("is_family_violence")).alias("family_violence_count"),
        )
    )


def trends_delta(changes: Changes) -> DataFrame:
    """The same from changes of the fact, in SQL, as a second opinion on it."""
    return changes.new.sparkSession.sql(
        """
        SELECT
          CAST(date_trunc('MONTH', occ_date) AS DATE) AS occ_month,
          crime_type,
          council_district,
          sum(sign * incident_count) AS incident_count,
          sum(CASE WHEN is_cleared IS NOT NULL THEN sign ELSE 0 END)
            AS known_clearance_count,
          sum(CASE WHEN is_cleared THEN sign ELSE 0 END) AS cleared_count,
          sum(CASE WHEN is_family_violence THEN sign ELSE 0 END)
            AS family_violence_count
        FROM {changed}
        GROUP BY ALL
        """,
        changed=signed(changes),
    )


def rates_delta(changes: Changes) -> DataFrame:
    """What the clearance counts gain and lose, from changes of the fact."""
    cleared = F.col("is_cleared")
    return (
        signed(changes)
        .groupBy(month_of(F.col("occ_date")).alias("occ_month"), "council_district")
        .agg(
            F.sum(F.col("sign") * F.col("incident_count")).alias("incident_count"),
            _sum_if(cleared.isNotNull()).alias("known_clearance_count"),
            _sum_if(cleared).alias("cleared_count"),
            _sum_if(~cleared).alias("not_cleared_count"),
            _sum_if(cleared.isNull()).alias("unknown_clearance_count"),
        )
    )


def added(
    stored: DataFrame, delta: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...]
) -> DataFrame:
    """The stored groups plus a delta; groups that fall to no incidents are gone.

    Both sides hold one row a group and are stacked, so NULL groups meet as well.
    """
    columns = [*keys, *measures]
    return (
        stored.select(*columns)
        .unionByName(delta.select(*columns))
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .filter(F.col(measures[0]) != 0)
    )


def changed_summary(stored: DataFrame, delta: DataFrame) -> DataFrame:
    return added(stored, delta, SUMMARY_KEYS, TREND_MEASURES)


def changed_rates(stored: DataFrame, delta: DataFrame) -> DataFrame:
    rate = ratio(F.col("cleared_count"), F.col("known_clearance_count"))
    return added(stored, delta, RATE_KEYS, RATE_MEASURES).withColumn(
        "clearance_rate", rate
    )


def negative_groups(stored: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Groups that lost more than they had: the stored aggregate was not the old one's."""
    below = F.lit(False)
    for measure in measures:
        below = below | (F.col(measure) < 0)
    return stored.filter(below)
