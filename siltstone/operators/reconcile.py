"""Comparison of a source key snapshot with a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.parsing import instant_of
from siltstone.operators.quality import side_by_side


def key_states(
    source: DataFrame,
    target: DataFrame,
    key: str = V.BUSINESS_KEY,
    updated_at: str = V.UPDATED_AT,
) -> DataFrame:
    """One row per key with its rows and update times on each side.

    Both sides are stacked and grouped by key instead of joined: one shuffle with
    partial aggregation serves every question below, and a repeated or NULL key
    becomes one small row instead of all its pairs.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col(key),
            F.col(updated_at).alias("_time"),
            F.lit(name == "source").alias("_is_source"),
        )

    def on(name: str, column) -> F.Column:
        here = F.col("_is_source") if name == "source" else ~F.col("_is_source")
        return F.when(here, column)

    def measures(name: str) -> list[F.Column]:
        return [
            F.count(on(name, F.lit(1))).alias(f"{name}_rows"),
            F.count(on(name, F.col("_time"))).alias(f"_{name}_timed"),
            F.min(on(name, F.col("_time"))).alias(f"_{name}_first"),
            F.max(on(name, F.col("_time"))).alias(f"{name}_{updated_at}"),
        ]

    stacked = side(source, "source").unionAll(side(target, "target"))
    return stacked.groupBy(key).agg(*measures("source"), *measures("target"))


def _absent(side: str) -> F.Column:
    """A NULL key matches nothing, so it is absent on both sides."""
    return F.col(f"{side}_rows") == 0


def _one_time(updated_at: str) -> F.Column:
    """All rows of the key carry the same time, or none has one."""
    last = F.col(f"source_{updated_at}")
    same = last.eqNullSafe(F.col(f"target_{updated_at}"))
    for side in ("source", "target"):
        timed = F.col(f"_{side}_timed")
        same = same & F.col(f"_{side}_first").eqNullSafe(F.col(f"{side}_{updated_at}"))
        same = same & ((timed == 0) | (timed == F.col(f"{side}_rows")))
    return same


def missing_from_target(states: DataFrame, key: str = V.BUSINESS_KEY) -> DataFrame:
    """Source keys the table lacks, with their number of source rows."""
    lacking = _absent("target") | F.col(key).isNull()
    return states.filter(lacking & ~_absent("source")).select(key, "source_rows")


def missing_from_source(states: DataFrame, key: str = V.BUSINESS_KEY) -> DataFrame:
    """Table keys the source lacks, with their number of table rows."""
    lacking = _absent("source") | F.col(key).isNull()
    return states.filter(lacking & ~_absent("target")).select(key, "target_rows")


def timestamp_mismatches(
    states: DataFrame, key: str = V.BUSINESS_KEY, updated_at: str = V.UPDATED_AT
) -> DataFrame:
    """Keys on both sides whose update times differ, NULL counting as a value."""
    return states.filter(
        F.col(key).isNotNull()
        & ~_absent("source")
        & ~_absent("target")
        & ~_one_time(updated_at)
    ).select(key, f"source_{updated_at}", f"target_{updated_at}")


def reconcile_summary(
    states: DataFrame, key: str = V.BUSINESS_KEY, updated_at: str = V.UPDATED_AT
) -> DataFrame:
    """One row with every reconciliation count, from one pass over the states."""
    null_key = F.col(key).isNull()
    rows = {side: F.col(f"{side}_rows") for side in ("source", "target")}
    other = {"source": "target", "target": "source"}
    measures = []
    for side, count in rows.items():
        known = ~null_key & (count > 0)
        measures += [
            F.sum(count).alias(f"{side}_count"),
            F.count_if(count > 0).alias(f"{side}_unique_count"),
            F.sum(F.when(null_key, count).otherwise(0)).alias(f"{side}_null_keys"),
            F.count_if(known & (count > 1)).alias(f"{side}_repeated_keys"),
        ]
    for side, count in rows.items():
        lacking = null_key | _absent(other[side])
        measures.append(
            F.sum(F.when(lacking, count).otherwise(0)).alias(
                f"missing_from_{other[side]}"
            )
        )
    both = ~null_key & ~_absent("source") & ~_absent("target")
    measures.append(
        F.count_if(both & ~_one_time(updated_at)).alias("timestamp_mismatches")
    )
    return states.agg(*measures).na.fill(0)


def reconcile_problems(summary: DataFrame) -> DataFrame:
    """The failed checks of a reconciliation summary; empty when all passed."""
    col = F.col
    checks = {
        "Repeated keys in the source snapshot.": col("source_count")
        != col("source_unique_count"),
        "Repeated keys in the table.": col("target_count")
        != col("target_unique_count"),
        "NULL keys.": (col("source_null_keys") > 0) | (col("target_null_keys") > 0),
        "Source keys missing from the table.": col("missing_from_target") > 0,
        "Table keys missing from the source.": col("missing_from_source") > 0,
        "Update times differ.": col("timestamp_mismatches") > 0,
    }
    failed = F.array(*[F.when(bad, F.lit(text)) for text, bad in checks.items()])
    return summary.select(F.explode(F.array_compact(failed)).alias("problem"))


def compare_summaries(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts and latest update times of two one-row summaries, as instants.

    A difference is a warning; the full reconciliation decides.
    """
    pair = side_by_side(
        source=source.select("record_count", _latest(source)),
        target=target.select("record_count", _latest(target)),
    )
    counts = F.col("source_record_count") == F.col("target_record_count")
    times = F.col("source_max_updated_at").eqNullSafe(F.col("target_max_updated_at"))
    return pair.select(
        "*",
        counts.alias("counts_match"),
        times.alias("timestamps_match"),
        (counts & times).alias("summaries_match"),
    )


def _latest(summary: DataFrame) -> F.Column:
    return instant_of(summary, "max_updated_at").alias("max_updated_at")
