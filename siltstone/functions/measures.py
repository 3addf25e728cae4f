"""Aggregate and date expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def days_forward(start: Column, end: Column) -> Column:
    """Days from start to end as a long; NULL when negative or unknown."""
    return F.when(end >= start, F.datediff(end, start).cast("long"))


def missing(column: Column) -> Column:
    return F.count(F.lit(1)) - F.count(column)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed whole seconds, rounded; NULL when either end is unknown."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.round(micros / F.lit(1_000_000)).cast("long")
