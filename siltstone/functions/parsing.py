"""Text to typed values. Text that does not fit becomes NULL, never an error."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import values as V


def parse_date(text: Column) -> Column:
    return F.try_to_date(text, V.DATE_TEXT)


def parse_instant(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(V.INSTANT_TEXT))


def parse_local_time(text: Column) -> Column:
    """Wall-clock text without a zone; runs of white space count as one space.

    Made from its numbers, so a time that the session's zone skips stays what it is.
    The numbers have fixed places from either end of what the pattern finds, so it is
    sought once. Other text is NULL before the casts: a failed one costs
    Spark an exception.
    """
    found = F.regexp_substr(F.trim(text), F.lit(V.LOCAL_TIME_PATTERN))

    def number(start: int, length: int) -> Column:
        return F.substring(found, start, length).try_cast("int")

    month, day, year = number(1, 2), number(4, 2), number(7, 4)
    hour, minute = number(-5, 2), number(-2, 2)
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))


def parse_whole_number(text: Column, to: str = "integer") -> Column:
    """Integer text; a decimal fraction is cut off, other text NULL.

    "7.0" is 7, and a fraction without digits before it, ".5" or ".", is 0. Patterns
    are only sought in text with a point, which is no whole number as it stands; it is
    not cast either, as a failed cast is dear.
    """
    whole = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    bare = text.rlike(r"^\s*[+-]?\.\d*\s*$")
    cut = F.when(bare, F.lit(0).cast(to)).otherwise(whole.try_cast(to))
    return F.when(text.contains("."), cut).otherwise(text.try_cast(to))


def iso_millis(instant: Column) -> Column:
    """ISO text with milliseconds; ends in Z when the session zone is UTC."""
    return F.date_format(instant, V.ISO_MILLIS_TEXT)


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))


def yes_no(text: Column) -> Column:
    code = upper_trimmed(text)
    return F.when(code == V.FLAG_TRUE, True).when(code == V.FLAG_FALSE, False)


def cleared_flag(status: Column) -> Column:
    return F.when(status.isin(*V.CLEARED_CODES), True).when(
        status == V.NOT_CLEARED_CODE, False
    )


def instant_of(df: DataFrame, name: str, column: Column | None = None) -> Column:
    """The column as an ordered value: text is parsed, anything else is kept."""
    column = F.col(name) if column is None else column
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_instant(column)
    return column
