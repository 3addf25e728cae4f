"""Dashboard metrics and charts over the monthly trends mart."""

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.measures import ratio
from siltstone.functions.predicates import in_complete_month


def metric(name: str) -> Column:
    """A named metric of the mart; rates are ratios of sums, not means of rates."""
    metrics = {
        "total_incidents": F.sum("incident_count"),
        "cleared_incidents": F.sum("cleared_count"),
        "clearance_rate": ratio(
            F.sum("cleared_count"), F.sum("known_clearance_count")
        ),
        "family_violence_rate": ratio(
            F.sum("family_violence_count"), F.sum("incident_count")
        ),
    }
    return metrics[name].alias(name)


def _day(bound: date | datetime | None) -> date | None:
    """The month column is a date, so a bound with a time counts as its day."""
    return bound.date() if isinstance(bound, datetime) else bound


def dashboard_filters(
    mart: DataFrame,
    *,
    since: date | datetime | None = None,
    until: date | datetime | None = None,
    types: Sequence[str] = (),
) -> DataFrame:
    """The filters every chart shares: months in [since, until) and some types."""
    if since is not None:
        mart = mart.filter(F.col("occ_month") >= F.lit(_day(since)))
    if until is not None:
        mart = mart.filter(F.col("occ_month") < F.lit(_day(until)))
    if types:
        mart = mart.filter(F.col("crime_type").isin(*types))
    return mart


def complete_months(mart: DataFrame, as_of: date | None = None) -> DataFrame:
    return mart.filter(in_complete_month(F.col("occ_month"), as_of))


def chart(
    mart: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str] = (),
    *,
    order_by: Sequence[Column] = (),
    rows: int | None = None,
) -> DataFrame:
    """Metrics per group in the given order, at most ``rows`` of them if given."""
    grouped = mart.groupBy(*by).agg(*[metric(name) for name in metrics])
    if order_by:
        grouped = grouped.orderBy(*order_by)
    return grouped if rows is None else grouped.limit(rows)


def headline(mart: DataFrame, *names: str) -> DataFrame:
    """One row of metrics over the whole (filtered) mart."""
    return chart(mart, names)


def _largest_first(by: str) -> list[Column]:
    return [F.desc("total_incidents"), F.col(by)]


def district_share(
    mart: DataFrame, as_of: date | None = None, rows: int | None = V.SHARE_ROWS
) -> DataFrame:
    """Incidents per district and the share of those shown.

    The window spans the chart rows only, which ``rows`` bounds.
    """
    shown = chart(
        complete_months(mart, as_of).filter(F.col("council_district").isNotNull()),
        ["total_incidents"],
        ["council_district"],
        order_by=_largest_first("council_district"),
        rows=rows,
    )
    everything = F.sum("total_incidents").over(Window.partitionBy())
    return shown.select(
        "*", ratio(F.col("total_incidents"), everything).alias("contribution")
    )


def monthly_series(
    mart: DataFrame,
    as_of: date | None = None,
    *,
    since: date | datetime | None = None,
    until: date | datetime | None = None,
    rows: int | None = V.CHART_ROWS,
) -> DataFrame:
    """Incidents per month: of complete months, or of a fixed range when given."""
    if since is None and until is None:
        mart = complete_months(mart, as_of)
    return chart(
        dashboard_filters(mart, since=since, until=until),
        ["total_incidents"],
        ["occ_month"],
        order_by=_largest_first("occ_month"),
        rows=rows,
    )


def top_types(
    mart: DataFrame, as_of: date | None = None, rows: int | None = V.TOP_TYPES
) -> DataFrame:
    """The types with most incidents, shown smallest first."""
    top = chart(
        complete_months(mart, as_of),
        ["total_incidents"],
        ["crime_type"],
        order_by=_largest_first("crime_type"),
        rows=rows,
    )
    return top.orderBy("total_incidents", F.desc("crime_type"))


def incidents_by_district(
    mart: DataFrame, as_of: date | None = None, rows: int | None = V.CHART_ROWS
) -> DataFrame:
    return chart(
        complete_months(mart, as_of).filter(F.col("council_district").isNotNull()),
        ["total_incidents"],
        ["council_district"],
        order_by=_largest_first("council_district"),
        rows=rows,
    )
