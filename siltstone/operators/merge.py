"""Conditional upsert, its checks, and the difference of two snapshots.

Updates hold one row per key (see ``dedupe_latest``); a target may hold a key
more than once, in which case every matching row is replaced, as MERGE does.

``small_updates`` picks the join. It may be set once the updates are known to be
small (``fits_broadcast`` measures it): the target is then filtered and rewritten
in place of being shuffled. Otherwise both sides are shuffled by key once.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.functions.parsing import instant_of
from siltstone.functions.predicates import accounts_for, holds, supersedes

TYPED = "typed"
TEXT = "text"

# Upper bounds of what a merge broadcasts.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

Keys = str | Sequence[str]


def _names(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fits_broadcast(
    updates: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """Whether the updates are within both bounds, measured on the rows.

    Over stored Parquet the row count comes from the footers, and the bytes are
    only summed when the rows are few.
    """
    if updates.count() > max_rows:
        return False
    width = F.lit(0)
    for field in updates.schema:
        text = F.col(field.name).cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + 16
    return (updates.agg(F.sum(width.cast("long"))).first()[0] or 0) <= max_bytes


def _time(df: DataFrame, name: str, column: Column, compare: str) -> Column:
    """Times compare as instants, or as the stored text when ``compare`` is TEXT."""
    return column if compare == TEXT else instant_of(df, name, column)


def _target_state(
    updates: DataFrame,
    target: DataFrame,
    keys: list[str],
    columns: list[str],
    small_updates: bool,
) -> DataFrame:
    """Keys and compared columns of the target, with a ``target_`` prefix."""
    state = target.select(*keys, *columns)
    if small_updates:
        state = state.join(F.broadcast(updates.select(*keys)), keys, "left_semi")
    return state.select(*[F.col(c).alias(f"target_{c}") for c in state.columns])


def _same_key(keys: list[str]) -> list[Column]:
    return [F.col(k) == F.col(f"target_{k}") for k in keys]


def merge_candidates(
    updates: DataFrame,
    target: DataFrame,
    key: Keys = V.BUSINESS_KEY,
    updated_at: str = V.UPDATED_AT,
    version: str = V.VERSION,
    *,
    compare: str = TYPED,
    small_updates: bool = False,
) -> DataFrame:
    """Updates that are new or supersede the target, with the target's state."""
    keys = _names(key)
    state = _target_state(updates, target, keys, [updated_at, version], small_updates)
    new_time = _time(updates, updated_at, F.col(updated_at), compare)
    old_time = _time(target, updated_at, F.col(f"target_{updated_at}"), compare)
    return updates.join(state, _same_key(keys), "left").filter(
        F.col(f"target_{keys[0]}").isNull()
        | supersedes(new_time, F.col(version), old_time, F.col(f"target_{version}"))
    )


def unapplied_rows(
    updates: DataFrame,
    target: DataFrame,
    key: Keys = V.BUSINESS_KEY,
    updated_at: str = V.UPDATED_AT,
    version: str = V.VERSION,
    *,
    compare: str = TYPED,
    small_updates: bool = False,
) -> DataFrame:
    """Updates the target neither holds nor supersedes; empty after a good merge."""
    keys = _names(key)
    state = _target_state(updates, target, keys, [updated_at, version], small_updates)
    seen = accounts_for(
        _time(target, updated_at, F.col(f"target_{updated_at}"), compare),
        F.col(f"target_{version}"),
        _time(updates, updated_at, F.col(updated_at), compare),
        F.col(version),
    )
    return updates.join(state, [*_same_key(keys), seen], "left_anti")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Keys = V.BUSINESS_KEY,
    updated_at: str | None = V.UPDATED_AT,
    version: str = V.VERSION,
    *,
    compare: str = TYPED,
    set_columns: Sequence[str] | None = None,
    small_updates: bool = False,
) -> DataFrame:
    """The target after inserting new keys and replacing superseded rows.

    ``updated_at=None`` replaces every matched row. ``set_columns`` limits what a
    match replaces; an insert always takes the whole row.
    """
    keys = _names(key)
    lacking = [c for c in target.columns if c not in updates.columns]
    if lacking:
        raise ValueError(f"Updates lack target columns: {lacking}")
    old = target.withColumn("_old", F.lit(True))
    new = updates.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys],
        F.lit(True).alias("_new"),
    )
    if updated_at is None:
        wins = F.lit(True)
    else:
        wins = supersedes(
            _time(updates, updated_at, F.col(f"_new_{updated_at}"), compare),
            F.col(f"_new_{version}"),
            _time(target, updated_at, F.col(updated_at), compare),
            F.col(version),
        )
    matched = holds(F.col("_new")) & holds(F.col("_old"))
    inserted = F.col("_old").isNull()
    replaced = set(target.columns if set_columns is None else set_columns)

    def result(name: str) -> Column:
        if name in keys:
            return F.col(name)
        takes_new = inserted | (matched & wins) if name in replaced else inserted
        return F.when(takes_new, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    columns = [result(c) for c in target.columns]
    if not small_updates:
        return old.join(new, keys, "full_outer").select(*columns)
    rewritten = old.join(F.broadcast(new), keys, "left").select(*columns)
    known = target.select(*keys).join(
        F.broadcast(updates.select(*keys)), keys, "left_semi"
    )
    fresh = updates.join(known, keys, "left_anti").select(*target.columns)
    return rewritten.unionByName(fresh)


def version_diff(
    table,
    old: int,
    new: int,
    key: str,
    business_columns: Sequence[str],
    system_columns: Sequence[str] = (),
) -> DataFrame:
    """``snapshot_diff`` of two stored versions of a table in parts.

    Parts that have the same folder in both versions are counted from the lists; only
    the others are read and joined. A key that moved has its row in two such parts.
    """
    before, after = table.version(old), table.version(new)
    same = {n for n, p in before.parts.items() if after.parts.get(n) == p}
    changed = sorted((before.parts.keys() | after.parts.keys()) - same)
    found = snapshot_diff(
        table.read(changed, before),
        table.read(changed, after),
        key,
        business_columns,
        system_columns,
    )
    unchanged = F.col("unchanged") + F.lit(before.records(same)).cast("long")
    return found.withColumn("unchanged", unchanged)


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    key: str,
    business_columns: Sequence[str],
    system_columns: Sequence[str] = (),
) -> DataFrame:
    """Counts of inserted, removed, changed and unchanged keys between snapshots.

    Values are compared as a whole and exactly. ``<column>_changed`` counts the
    matched keys whose system column differs.
    """
    columns = [*business_columns, *system_columns]
    left = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    right = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    both = left.withColumn("_old", F.lit(True)).join(
        right.withColumn("_new", F.lit(True)), key, "full_outer"
    )
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def same(name: str) -> Column:
        return F.col(f"_old_{name}").eqNullSafe(F.col(f"_new_{name}"))

    unchanged = F.lit(True)
    for name in business_columns:
        unchanged = unchanged & same(name)
    return both.agg(
        F.count_if(F.col("_old").isNull()).alias("inserted"),
        F.count_if(F.col("_new").isNull()).alias("removed"),
        F.count_if(matched & ~unchanged).alias("changed"),
        F.count_if(matched & unchanged).alias("unchanged"),
        *[
            F.count_if(matched & ~same(name)).alias(f"{name}_changed")
            for name in system_columns
        ],
    )
