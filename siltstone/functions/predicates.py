"""Boolean expressions shared by gates, merges and charts."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(text: Column) -> Column:
    """NULL, empty or spaces only."""
    return text.isNull() | (F.trim(text) == "")


def holds(condition: Column) -> Column:
    """Three-valued to two-valued: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def supersedes(
    new_time: Column, new_version: Column, old_time: Column, old_version: Column
) -> Column:
    """Whether a new row replaces the stored row of the same key.

    It does when the stored time is unknown, when the new time is later, or when
    times are equal and versions differ in any way, NULL included.
    """
    return holds(
        old_time.isNull()
        | (new_time > old_time)
        | ((new_time == old_time) & ~new_version.eqNullSafe(old_version))
    )


def accounts_for(
    stored_time: Column, stored_version: Column, new_time: Column, new_version: Column
) -> Column:
    """Whether the stored row shows that the new row was applied or is outdated."""
    return (stored_time > new_time) | (
        (stored_time == new_time) & stored_version.eqNullSafe(new_version)
    )


def within(value: Column, after, until) -> Column:
    """Open below, closed above; the bounds may be literals or columns."""
    return (value > after) & (value <= until)


def in_complete_month(month: Column, as_of: date | None = None) -> Column:
    """Months before the one holding ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return month < F.trunc(today, "month")
