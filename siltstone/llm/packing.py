"""Packing of tokenised documents into sequences by a grouping genetic algorithm.

A chromosome is a list of bins. Crossover injects whole well-filled bins of one
parent into another, drops the bins that would hold a piece twice, and puts the
displaced pieces back by best fit. Pieces are dealt by hash into blocks of bounded
size; every block evolves on several islands, one row each, and after each epoch an
island's elite migrates to the next one. Bins that stay badly filled are given up
and their pieces dealt anew into as many blocks as they need, until one block is left
or packing them again saves no sequence.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import map_rows, staged, texts_of

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k"
END = "<|endoftext|>"

#: Pieces of a block, about; hashing deals them evenly.
BLOCK_PIECES = 4000
ISLANDS, EPOCHS, POPULATION = 2, 2, 12
#: An island evolves until its block has as few bins as its pieces allow, or until
#: this many generations have passed without one bin less.
PATIENCE = 20
#: A bin is passed on whole by crossover, and kept at the end, from this fill on.
FULL = 0.98


def _encoder(tokenizer: str):
    """``text -> little-endian unsigned 32-bit ids``, of one task.

    Uses the byte-pair ranks of the same vocabulary, whose ids come as one buffer; a
    text that holds the special token goes through the tokenizer file itself.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{tokenizer}.tiktoken"), "rb") as lines:
        pairs = map(bytes.split, lines)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    fast = tiktoken.Encoding(
        tokenizer,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )
    whole = []

    def encode(text: str) -> bytes:
        if END in text:
            if not whole:
                path = public_tokenizers.path(f"{tokenizer}.json")
                whole.append(Tokenizer.from_file(path))
            ids = whole[0].encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()

    return encode


def pieces(
    documents: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document.

    A document is its ids and a closing 0, so null and empty texts have one token.
    Only a document over ``capacity`` is cut; all its pieces but the first are full.
    """
    held: list = []

    def rows(batch):
        if not held:
            held.append(_encoder(tokenizer))
        made = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        ids_of = batch["doc_id"].to_pylist()
        for doc_id, text in zip(ids_of, texts_of(batch["text"]), strict=True):
            ids = held[0](text.decode("utf-8", "replace")) + bytes(4)
            total = len(ids) // 4
            first = total % capacity or capacity
            starts = [0, *range(min(first, total), total, capacity)]
            for number, (a, b) in enumerate(
                zip(starts, [*starts[1:], total], strict=True)
            ):
                part = ids[4 * a : 4 * b]
                made["doc_id"].append(doc_id)
                made["piece"].append(number)
                made["start"].append(a)
                made["length"].append(b - a)
                made["ids_crc32"].append(zlib.crc32(part))
                made["ids"].append(part)
        return made

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" * with_ids
    return map_rows(documents.select("doc_id", "text"), rows, schema)


# One island: lists of bins of item numbers, over the lengths of a block's pieces.


def _best_fit(items: list[int], lengths: list[int], bins: list[list[int]], room: int):
    """Put items, longest first, where least room stays; opens bins as needed."""
    free: dict[int, list[int]] = {}
    mask = 0
    for number, members in enumerate(bins):
        left = room - sum(lengths[i] for i in members)
        free.setdefault(left, []).append(number)
        mask |= 1 << left
    for item in sorted(items, key=lengths.__getitem__, reverse=True):
        size = lengths[item]
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = free[left].pop()
            if not free[left]:
                mask ^= 1 << left
            bins[number].append(item)
        else:
            left, number = room, len(bins)
            bins.append([item])
        left -= size
        if not free.get(left):
            free[left] = []
            mask |= 1 << left
        free[left].append(number)
    return bins


def _fill(members: list[int], lengths: list[int]) -> int:
    return sum(lengths[i] for i in members)


def _fitness(bins: list[list[int]], lengths: list[int], room: int) -> tuple:
    """Fewer bins, then more uneven fills (room gathered in few bins)."""
    return -len(bins), sum(_fill(b, lengths) ** 2 for b in bins) / room**2


def _crossed(a, b, lengths, room, rng):
    well = [m for m in b if _fill(m, lengths) >= FULL * room]
    if not well:
        well = sorted(b, key=lambda m: -_fill(m, lengths))[: 1 + len(b) // 4]
    taken = rng.random(len(well)) < 0.5
    injected = [list(m) for m, t in zip(well, taken, strict=True) if t]
    inside = {i for m in injected for i in m}
    kept, displaced = [], []
    for members in a:
        if inside.isdisjoint(members):
            kept.append(list(members))
        else:
            displaced += [i for i in members if i not in inside]
    # The emptiest bins are dissolved too, so that best fit has room to move.
    kept.sort(key=lambda m: _fill(m, lengths))
    loose = sum(1 for m in kept if _fill(m, lengths) < FULL * room)
    for members in kept[: max(1, loose // 2)] if loose else []:
        displaced += members
    kept = kept[max(1, loose // 2) :] if loose else kept
    return _best_fit(displaced, lengths, injected + kept, room)


def _evolve(lengths: list[int], elites: list, room: int, seed: int) -> list:
    """The best bins found, from the elites and fresh packings.

    Evolution goes on as long as it saves bins, so it ends.
    """
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // room)
    population = [[list(m) for m in e] for e in elites]
    if not population:
        population.append(_best_fit(list(range(len(lengths))), lengths, [], room))
    if len(population[0]) > least:
        while len(population) < POPULATION:
            # Some pieces first, in any order: another packing to cross with.
            order = rng.permutation(len(lengths)).tolist()
            cut = len(order) // 4
            start = [[i] for i in order[:cut]]
            merged = _best_fit(order[cut:], lengths, start, room)
            population.append(merged)

    def ranked(packings: list) -> list:
        return sorted(
            packings, key=lambda p: _fitness(p, lengths, room), reverse=True
        )[:POPULATION]

    population, waited = ranked(population), 0
    while len(population[0]) > least and waited < PATIENCE:
        fewest = len(population[0])
        a, b = population[0], population[1 + int(rng.integers(len(population) - 1))]
        children = [_crossed(a, b, lengths, room, rng), _crossed(b, a, lengths, room, rng)]
        population = ranked(population + children)
        waited = 0 if len(population[0]) < fewest else waited + 1
    return population[0]


def _epoch(islands: DataFrame, room: int, epoch: int) -> DataFrame:
    """Evolve each row: its elites go in, its best packing comes out."""

    def run(batches: Iterator):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                lengths = [int(x) for x in row["lengths"]]
                elites = [_bins(np.frombuffer(e, "<i4")) for e in row["elites"]]
                seed = (row["block"] * 1009 + row["island"]) * 31 + epoch
                best = _evolve(lengths, elites, room, seed & 0x7FFFFFFF)
                row["elites"] = [_places(best, len(lengths))]
                row["bins"] = len(best)
                yield pd.DataFrame([row])

    return islands.mapInPandas(run, islands.schema)


def _places(bins: list[list[int]], n: int) -> bytes:
    place = np.zeros(n, "<i4")
    for number, members in enumerate(bins):
        place[members] = number
    return place.tobytes()


def _bins(place: np.ndarray) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(int(place.max(initial=-1)) + 1)]
    for item, number in enumerate(place.tolist()):
        bins[number].append(item)
    return [b for b in bins if b]


def _migrated(islands: DataFrame) -> DataFrame:
    """Each island also gets the elite of its neighbour in the ring."""
    ring = Window.partitionBy("block").orderBy("island")
    around = Window.partitionBy("block")
    neighbour = F.coalesce(
        F.lag("elites").over(ring), F.max_by("elites", "island").over(around)
    )
    return islands.withColumn("elites", F.concat("elites", neighbour))


def _pack_blocks(loose: DataFrame, blocks: int, room: int, level: int) -> DataFrame:
    """``row, length, level, block, bin, fill`` of every piece in ``loose``."""
    dealt = loose.select(
        "row", "length", F.pmod(F.xxhash64("row", F.lit(level)), blocks).alias("block")
    )
    grouped = dealt.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("row", "length"))).alias("items")
    )
    islands = grouped.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("items.length").alias("lengths"),
        F.col("items.row").alias("rows"),
        F.array().cast("array<binary>").alias("elites"),
        F.lit(0).alias("bins"),
    )
    # Islands are few bytes and long work, so they are spread by number.
    spread = min(ISLANDS * blocks, 2000)
    for epoch in range(EPOCHS):
        begun = _migrated(islands) if epoch else islands
        islands = _epoch(begun.repartition(spread, "block", "island"), room, epoch)
    best = staged(islands, "packing")

    # Of each block, the island with fewest bins.
    chosen = best.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("top"))
    chosen = chosen.select("block", F.col("top.island").alias("island"))
    winners = best.join(chosen, ["block", "island"], "left_semi")
    schema = "row long, length long, block long, bin int, fill long, offset long"
    unfolded = winners.mapInPandas(_unfolded, schema)
    return unfolded.withColumn("level", F.lit(level))


def _unfolded(batches: Iterator) -> Iterator:
    """A row for each piece of a packed block."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            place = np.frombuffer(row.elites[0], "<i4")
            order = np.argsort(place, kind="stable")
            place, sizes = place[order], np.array(row.lengths, np.int64)[order]
            begins = np.cumsum(sizes) - sizes
            members = np.bincount(place)
            first = np.cumsum(members) - members
            fills = np.bincount(place, weights=sizes).astype(np.int64)
            yield pd.DataFrame(
                {
                    "row": np.array(row.rows, np.int64)[order],
                    "length": sizes,
                    "block": row.block,
                    "bin": place,
                    "fill": fills[place],
                    "offset": begins - np.repeat(begins[first], members),
                }
            )


def pack(
    documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; no sequence over ``capacity``.

    Null text counts as empty; repeated rows are packed each; an empty table gives
    no rows. A full piece is a sequence of its own.
    """
    rows = pieces(documents, tokenizer, capacity)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "packing")
    loose = rows.where(F.col("length") < capacity).select("row", "length")
    bad, first = F.col("fill") < FULL * capacity, F.col("offset") == 0
    count, done, given_up, sequences, level = loose.count(), None, None, 0, 0
    while True:
        # As many blocks as the pieces left need, so no block outgrows its bound.
        blocks = max(1, -(-count // BLOCK_PIECES))
        packed = staged(_pack_blocks(loose, blocks, capacity, level), "packing")
        made, left, count = packed.agg(
            F.count_if(first), F.count_if(first & bad), F.count_if(bad)
        ).first()
        if given_up is not None and made >= sequences:
            # No fewer sequences: those given up last stand.
            done = done.unionByName(given_up)
            break
        last = blocks == 1 or count == 0
        kept = packed if last else packed.where(~bad)
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        given_up, sequences = packed.where(bad), left
        loose = given_up.select("row", "length")
        level += 1
    # Level, block and bin as one number; a full piece has a negative one.
    number = F.expr(
        "shiftleft(cast(level AS bigint), 48) | shiftleft(block, 20) | cast(bin AS bigint)"
    )
    places = done.select("row", number.alias("sequence_id"), "offset")
    full = F.col("length") == capacity
    return (
        rows.join(places, "row", "left")
        .withColumn("sequence_id", F.when(full, -1 - F.col("row")).otherwise(F.col("sequence_id")))
        .withColumn("offset", F.when(full, F.lit(0)).otherwise(F.col("offset")).cast("long"))
        .drop("row")
    )
