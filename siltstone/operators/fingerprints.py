"""Comparison of keys by fingerprints of key ranges, opening only ranges that differ.

A fingerprint is the number of rows of a range and sums of the hashes of their key and
time, which do not depend on order and count repeated rows. Two sides with the same
fingerprint hold the same rows (two sums of 64-bit hashes agree by chance about once in
10^19 pairs of ranges), so nothing in the range is missing or changed. What is read and
shuffled by key are the rows of the other ranges alone; their limits reach the scan.

One assumption: the table side holds a key once, as its tests assert. Rows without a
key match nothing, so their range is always opened.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import values as V

RANGES = 64
#: Keys that the limits are taken from; they decide only how even the ranges are.
SAMPLE_KEYS = 4096
NO_KEY = -1


def range_limits(
    df: DataFrame, key: str = V.BUSINESS_KEY, ranges: int = RANGES
) -> list:
    """First keys of all ranges but the lowest, evenly spaced among sampled keys.

    The sample is a share of the keys by hash, so a repeated run has the same limits.
    """
    rows = df.agg(F.count(key)).first()[0]
    if rows == 0 or ranges < 2:
        return []
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 31))
    share = min(SAMPLE_KEYS / rows, 1.0)
    sample = (
        df.filter(F.col(key).isNotNull() & (drawn < int(share * (1 << 31)) + 1))
        .select(key)
        .distinct()
        .orderBy(key)
        .limit(4 * SAMPLE_KEYS)
        .collect()
    )
    keys = [row[0] for row in sample]
    places = [len(keys) * i // ranges for i in range(1, ranges)]
    return sorted({keys[p] for p in places if 0 < p < len(keys)})


def range_of(key: Column, limits: Sequence) -> Column:
    """Number of the range of a key, by halving: as many comparisons as its logarithm."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(limits[middle]), among(low, middle)).otherwise(
            among(middle + 1, high)
        )

    return F.when(key.isNull(), NO_KEY).otherwise(among(0, len(limits)))


def in_ranges(key: Column, limits: Sequence, ranges: Sequence[int]) -> Column:
    """Whether a key is in one of the ranges, as comparisons that a scan can use."""

    def inside(number: int) -> Column:
        if number == NO_KEY:
            return key.isNull()
        bounds = F.lit(True)
        if number > 0:
            bounds = bounds & (key >= F.lit(limits[number - 1]))
        if number < len(limits):
            bounds = bounds & (key < F.lit(limits[number]))
        return bounds if limits else key.isNotNull()

    return reduce(lambda a, b: a | b, [inside(n) for n in ranges], F.lit(False))


def fingerprints(
    df: DataFrame,
    limits: Sequence,
    key: str = V.BUSINESS_KEY,
    updated_at: str = V.UPDATED_AT,
) -> DataFrame:
    """Rows and hash sums by range; one row a range leaves each map task."""
    digest = F.xxhash64(F.col(key), F.col(updated_at), F.col(updated_at).isNull())
    halves = {
        "low_sum": digest.bitwiseAND(F.lit(0xFFFFFFFF)),
        "high_sum": F.shiftrightunsigned(digest, 32),
    }
    return df.groupBy(range_of(F.col(key), limits).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(half).alias(name) for name, half in halves.items()],
    )


def compared_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both fingerprints of each range, and whether they are ``equal``."""
    parts = ("rows", "low_sum", "high_sum")
    sides = [
        df.select("range", *[F.col(p).alias(f"{name}_{p}") for p in parts])
        for name, df in (("source", source), ("target", target))
    ]
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"source_{p}").eqNullSafe(F.col(f"target_{p}")) for p in parts],
    )
    joined = sides[0].join(sides[1], "range", "full_outer")
    return joined.select(
        "range",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        (same & (F.col("range") != NO_KEY)).alias("equal"),
    )


def differing(
    source: DataFrame,
    target: DataFrame,
    key: str = V.BUSINESS_KEY,
    updated_at: str = V.UPDATED_AT,
    ranges: int = RANGES,
) -> tuple[DataFrame, DataFrame, int]:
    """The rows of both sides in ranges that differ, and the rows a side in the others.

    Limits and verdicts, one row a range, pass through the driver.
    """
    limits = range_limits(target, key, ranges)
    sides = [fingerprints(df, limits, key, updated_at) for df in (source, target)]
    verdicts = compared_ranges(*sides).collect()
    opened = sorted(row["range"] for row in verdicts if not row["equal"])
    equal = sum(row["source_rows"] for row in verdicts if row["equal"])
    wanted = in_ranges(F.col(key), limits, opened)
    return source.filter(wanted), target.filter(wanted), equal


def with_equal_rows(summary: DataFrame, equal: int) -> DataFrame:
    """A reconciliation summary of opened ranges, plus the rows of the equal ones."""
    counted = [f"{s}_{c}" for s in ("source", "target") for c in ("count", "unique_count")]
    return summary.withColumns({c: F.col(c) + F.lit(equal) for c in counted})

