"""Data-quality checks. Each returns violations or one summary row."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone.operators.marts import TREND_MEASURES


class QualityError(ValueError):
    """A check found violations."""


def require_empty(violations: DataFrame, message: str, shown: int = 5) -> None:
    """Raise when there is any violation, with a few of them in the message."""
    found = violations.limit(shown).collect()
    if found:
        details = "; ".join(str(row.asDict()) for row in found)
        raise QualityError(f"{message} {details}")


def side_by_side(**one_row_frames: DataFrame) -> DataFrame:
    """One-row DataFrames as one row, columns prefixed by the argument name.

    The rows are stacked and folded, so nothing is joined.
    """
    named = [
        df.select([F.col(c).alias(f"{name}_{c}") for c in df.columns])
        for name, df in one_row_frames.items()
    ]
    stacked = reduce(
        lambda upper, lower: upper.unionByName(lower, allowMissingColumns=True), named
    )
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, for columns that have any, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count").filter(
        "null_count > 0"
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values of a column with their counts; NULLs do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter("record_count > 1")
    )


def accepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted ones with their counts."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


@dataclass(frozen=True)
class ModelTests:
    """Declared tests of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple], ...] = ()
    sums: tuple[str, ...] = ()


def model_profile(df: DataFrame, tests: ModelTests) -> DataFrame:
    """All that the declared tests need, as one row from one scan.

    ``null_``, ``repeated_`` and ``outside_`` count violations, ``sum_`` are totals.
    Each tested key is shuffled once, by the distinct count that all its tests share;
    every other measure is combined in the map tasks.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    for name in tests.not_null:
        measures.append(F.count_if(F.col(name).isNull()).alias(f"null_{name}"))
    for name in tests.unique:
        extra = F.count(name) - F.count_distinct(name)
        measures.append(extra.alias(f"repeated_{name}"))
    for name, accepted in tests.accepted:
        outside = F.count_if(~F.col(name).isin(*accepted))
        measures.append(outside.alias(f"outside_{name}"))
    for name in tests.sums:
        measures.append(F.sum(name).alias(f"sum_{name}"))
    return df.agg(*measures)


def model_violations(df: DataFrame, tests: ModelTests, profile: Row) -> list[str]:
    """The failed tests of a profile with a few of the rows behind each.

    The table is read again only for tests that failed.
    """
    found = []

    def report(text: str, rows: DataFrame) -> None:
        shown = "; ".join(str(row.asDict()) for row in rows.limit(5).collect())
        found.append(f"{text} {shown}")

    for name in tests.not_null:
        if profile[f"null_{name}"]:
            found.append(f"NULL in {name}: {profile[f'null_{name}']} rows.")
    for name in tests.unique:
        if profile[f"repeated_{name}"]:
            report(f"Repeated {name}.", unique(df, name))
    for name, accepted in tests.accepted:
        if profile[f"outside_{name}"]:
            report(f"Unknown {name}.", accepted_values(df, name, accepted))
    return found


def totals(fact: DataFrame, mart: DataFrame, measure: str = "incident_count") -> DataFrame:
    """The total of one measure in fact and mart, side by side."""
    total = F.sum(measure).alias("incidents")
    return side_by_side(fact=fact.agg(total), mart=mart.agg(total))


def totals_differ(
    fact: DataFrame, mart: DataFrame, measure: str = "incident_count"
) -> DataFrame:
    """The two totals when they differ, else nothing."""
    return totals(fact, mart, measure).filter("fact_incidents <> mart_incidents")


def clearance_imbalance(rates: DataFrame) -> DataFrame:
    """Rows of the clearance mart whose parts do not add up or rate is not a rate."""
    col = F.col
    return rates.filter(
        (
            col("incident_count")
            != col("known_clearance_count") + col("unknown_clearance_count")
        )
        | (
            col("known_clearance_count")
            != col("cleared_count") + col("not_cleared_count")
        )
        | (col("clearance_rate") < 0)
        | (col("clearance_rate") > 1)
    )


def layer_counts(
    base: DataFrame,
    clean: DataFrame,
    summary: DataFrame,
    fact: DataFrame,
    mart: DataFrame,
) -> DataFrame:
    """Incidents held by every layer, and whether they agree and are not zero."""
    records = F.count(F.lit(1)).alias("count")
    incidents = F.sum("incident_count").alias("count")
    counts = side_by_side(
        bronze=base.agg(records),
        silver=clean.agg(records),
        gold=summary.agg(incidents),
        fact=fact.agg(incidents),
        mart=mart.agg(incidents),
    )
    first, *others = [F.col(c) for c in counts.columns]
    agree = reduce(lambda a, b: a & b, [other.eqNullSafe(first) for other in others])
    return counts.withColumn("layers_agree", agree & (first > 0))


def bag_diff(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str] = (
        "occ_month",
        "crime_type",
        "council_district",
        *TREND_MEASURES,
    ),
) -> DataFrame:
    """Rows, as bags, that one side has more often than the other.

    ``surplus`` is positive for rows in excess on the left, negative on the right.
    Both differences come from one grouping; NULLs are equal, repeats count.
    """
    sides = left.select(*columns, F.lit(1).alias("_sign")).unionAll(
        right.select(*columns, F.lit(-1).alias("_sign"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("_sign").alias("surplus"))
        .filter("surplus <> 0")
    )


def bag_diff_counts(diff: DataFrame) -> DataFrame:
    """How many rows each side has in excess."""
    surplus = F.col("surplus")
    return diff.agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("left_only"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("right_only"),
    )
