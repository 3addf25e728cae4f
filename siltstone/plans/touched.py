"""Merges that rewrite only the parts of a table in which something changes."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import values as V
from siltstone.operators import merge
from siltstone.operators.deltas import Changes
from siltstone.operators.quality import QualityError, require_empty
from siltstone.sources.parts import PART, PartTable
from siltstone.sources.tables import staged

# Upper bound of keys that are broadcast without the rest of their rows.
BROADCAST_KEYS = 2_000_000


@dataclass(frozen=True)
class Merge:
    """How many updates had to be merged, the change set, and the parts rewritten."""

    merged: int
    changes: Changes | None
    parts: tuple[str, ...]


def _keyed(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join with keys, broadcast when measured to be few."""
    few = F.broadcast(keys) if merge.fits_broadcast(keys) else keys
    return rows.join(few, key, how)


def _key_groups(
    table: PartTable, keys: DataFrame, rows: DataFrame, parts: list[str], key: str
) -> list[tuple[list[str], DataFrame, bool]]:
    """The parts in groups, each with its keys and whether these may be broadcast.

    One group when all keys may be; else as many parts at once as have no more keys
    than that, each with the keys that ``rows`` have there.
    """
    if merge.fits_broadcast(keys, BROADCAST_KEYS):
        return [(parts, F.broadcast(keys), True)]
    placed = staged(rows.select(table.label().alias(PART), key).distinct(), "placed-keys")
    # One row a part.
    counts = dict.fromkeys(parts, 0) | {
        r[PART]: r["count"] for r in placed.groupBy(PART).count().collect()
    }
    together: list[list[str]] = []
    room = 0
    for part in sorted(counts, key=counts.get):
        if not together or counts[part] > room:
            together.append([])
            room = BROADCAST_KEYS
        together[-1].append(part)
        room -= counts[part]
    groups = []
    for names in together:
        own = placed.filter(F.col(PART).isin(names)).select(key)
        few = merge.fits_broadcast(own, BROADCAST_KEYS)
        groups.append((names, F.broadcast(own) if few else own, few))
    return groups


def _one_for_one(
    updates: DataFrame, candidates: DataFrame, old: DataFrame, key: str
) -> bool:
    """Whether all updates are to be merged, and each in place of one old row at most.

    When no old row is left over, the new rows are the updates as they are.
    """
    types = {field.name: field.dataType for field in updates.schema}
    if any(types.get(field.name) != field.dataType for field in old.schema):
        return False
    most, total = candidates.agg(F.max("replaced"), F.sum("replaced")).first()
    return most <= 1 and total == old.count() and candidates.count() == updates.count()


def replaced_keys(
    table: PartTable,
    changes: Changes,
    source_version: int | None = None,
    parts: Iterable[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> tuple[str, ...]:
    """Put the new rows of a change set in the place of the old ones.

    Reads and writes the parts that hold rows of either side (found here unless
    given); every other part keeps its folder. A row that moves to another part leaves
    its old one. Refuses when the table did not hold the old rows. ``check`` sees the
    new rows as they were written, before the commit.
    """
    version = table.version()
    touched = table.labels(changes.old, changes.new) if parts is None else list(parts)
    new = changes.new.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in version.layout]
    )
    groups = _key_groups(table, changes.keys, changes.old, touched, changes.key)
    stay = [
        (table.read(names, version).join(keys, changes.key, "left_anti"), few)
        for names, keys, few in groups
    ]
    # Few rows are shuffled together, so that small parts stay one file each.
    small = len(stay) == 1 and version.records(touched) <= merge.BROADCAST_ROWS
    folder = table.write(stay.pop()[0].unionByName(new) if small else new)
    if check is not None:
        check(table.written(folder, version.layout))
    for kept, few in stay:
        table.write(kept, folder, spread=not few)
    written = table.counted(folder, version.layout)
    found = sum(count for _, count in written.values())
    expected = version.records(touched) - changes.old.count() + changes.new.count()
    if found != expected:
        raise QualityError(f"{table.path}: {found} rows, {expected} expected.")
    table.commit(written, version.layout, touched, source_version)
    return tuple(touched)


def merge_touched(
    table: PartTable,
    updates: DataFrame,
    *,
    key: str = V.BUSINESS_KEY,
    compare: str = merge.TYPED,
) -> Merge:
    """Conditional upsert of one row per key into a table in key buckets.

    Only buckets that the updates fall in are compared, by key, time and version, and
    only those with something to merge are read whole and written anew. What was
    written is checked before it is committed. The updates are read more than once and
    may go on as the new rows, so stage them.
    """
    version = table.version()
    small = merge.fits_broadcast(updates)
    options = {"key": key, "compare": compare, "small_updates": small}
    compared = table.read(table.labels(updates), version)
    found = merge.merge_candidates(updates, compared, **options)
    # Once a key, however many rows of the table it has.
    replaced = F.count(f"target_{key}").alias("replaced")
    candidates = staged(found.groupBy(key).agg(replaced), "candidates")
    wanted = candidates.select(key)
    parts = table.labels(wanted)
    if not parts:
        return Merge(0, None, ())
    old = reduce(
        DataFrame.unionByName,
        [
            staged(table.read(names, version).join(keys, key, "left_semi"), "old-rows")
            for names, keys, _ in _key_groups(table, wanted, wanted, parts, key)
        ],
    )
    if _one_for_one(updates, candidates, old, key):
        applied = new = updates.filter(F.col(key).isNotNull()).select(*old.columns)
    else:
        applied = _keyed(updates, wanted, key, "left_semi")
        new = staged(merge.upsert(old, applied, key, compare=compare), "new-rows")
    changes = Changes(old, new, wanted, version.number, key)

    def check(written: DataFrame) -> None:
        require_empty(
            merge.unapplied_rows(applied, written, **options),
            "Incoming records were not applied to the base table.",
        )

    replaced_keys(table, changes, parts=parts, check=check)
    return Merge(wanted.count(), changes, tuple(parts))
