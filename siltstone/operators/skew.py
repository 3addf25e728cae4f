"""Joins that keep a hot key from landing in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is heavy: more than a task's fair part on any
#: cluster worth its name. There are at most ``1 / HEAVY_SHARE`` of them.
HEAVY_SHARE = 0.001
#: Keys that the frequent-items sketch tracks; its error is far below the share.
TRACKED = 20_000


def heavy_keys(
    rows: DataFrame, *keys: str, share: float = HEAVY_SHARE
) -> dict[str, list]:
    """For each key column the values with at least ``share`` of the rows.

    One pass with a frequent-items sketch a column, which is combined in the map tasks
    and never misses a value this frequent. None stands for NULL keys.
    """
    most = int(1 / share)
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k(`{k}`, {most}, {TRACKED})").alias(k) for k in keys],
        *[F.count_if(F.col(k).isNull()).alias(f"null {k}") for k in keys],
    ).first()
    least = max(share * found["rows"], 1)
    heavy = {}
    for key in keys:
        tracked = [r for r in found[key] or [] if r["item"] is not None]
        heavy[key] = [r["item"] for r in tracked if r["count"] >= least]
        if found[f"null {key}"] >= least:
            heavy[key].append(None)
    return heavy


def is_heavy(key: str, heavy: Sequence) -> Column:
    """Whether a key is one of the heavy ones; never NULL."""
    known = [value for value in heavy if value is not None]
    among = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return among | F.col(key).isNull() if None in heavy else among


def lookup(
    rows: DataFrame, known: DataFrame, key: str, heavy: Sequence | None = None
) -> DataFrame:
    """Left join of many rows to a table that has one row per key.

    The adaptive planner leaves a skewed join alone when an aggregation by the same
    key follows, and cannot split one on the wrong side. Here the rows of heavy keys,
    measured unless given, stay where they are and meet the few rows of the table with
    these keys, one a key, by broadcast; all others are joined plainly.
    """
    if heavy is None:
        heavy = heavy_keys(rows, key)[key]
    if not heavy:
        return rows.join(known, key, "left")
    hot = is_heavy(key, heavy)
    few = known.filter(F.col(key).isin([v for v in heavy if v is not None]))
    return (
        rows.filter(~hot)
        .join(known, key, "left")
        .unionByName(rows.filter(hot).join(F.broadcast(few), key, "left"))
    )
