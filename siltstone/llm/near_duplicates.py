"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Shingles of five words, weighted by how often a text has them, send out points of a
Poisson process; each signature slot keeps the shingle whose point comes first, and
a text stops as soon as no later point can change a slot. Texts that share a band of
slots are candidates. In each bucket all members are compared with one leader, the
member with most company over all buckets. Members that then still lie in different
classes are compared by their signatures, block by block, and pairs that may reach
the similarity are verified too, so no link is lost to the choice of leaders.
Exact copies are one node from the start.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import map_rows, staged, texts_of

SHINGLE, SIMILARITY = 5, 0.8
#: A pair at the least similarity shares no band with probability 0.0006.
BANDS, BAND_SLOTS = 40, 8
SLOTS = BANDS * BAND_SLOTS
#: A pair at the least similarity agrees on fewer slots with probability 0.00001.
LEAST_AGREEMENT = 0.7
#: Members of a bucket that are compared with as many others at a time.
BLOCK_MEMBERS = 256
CACHED_WORDS = 400_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array(
    [pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(1, SHINGLE + 1)], np.uint64
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingler():
    """``text -> (distinct shingle hashes, counts)`` of one task.

    A text of fewer than five words is one shingle; one without words has none.
    """
    known: dict[bytes, int] = {}

    def of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(words))
        last = len(words) - size + 1
        sums = np.zeros(last, np.uint64)
        for i in range(size):
            sums += codes[i : i + last] * _POWERS[i]
        return np.unique(_mixed(sums), return_counts=True)

    return of


def signatures(hashes: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """One row of ``SLOTS`` shingle hashes for each text; zeros without shingles."""
    texts = len(hashes)
    first = np.full((texts, SLOTS), np.inf)
    slots = np.zeros((texts, SLOTS), np.uint64)
    sizes = [len(h) for h in hashes]
    element = np.concatenate([*hashes, np.empty(0, np.uint64)])
    weight = 1 + np.log(np.concatenate([*counts, np.empty(0)])) / 8
    text = np.repeat(np.arange(texts), sizes)
    time = np.zeros(len(element))
    latest = np.full(texts, np.inf)
    seed = element.copy()
    while len(element):
        seed += _STEP
        drawn = _mixed(seed)
        time -= np.log(((drawn >> np.uint64(11)) + 0.5) * 2.0**-53) / weight
        alive = time < latest[text]
        element, weight, text = element[alive], weight[alive], text[alive]
        time, seed, drawn = time[alive], seed[alive], drawn[alive]
        slot = (_mixed(drawn ^ _STEP) >> np.uint64(32)) * np.uint64(SLOTS)
        place = text * SLOTS + (slot >> np.uint64(32)).astype(np.int64)
        earlier = np.flatnonzero(time < first.flat[place])
        # The earliest point is written last and stays.
        earlier = earlier[np.lexsort((element[earlier], -time[earlier]))]
        first.flat[place[earlier]] = time[earlier]
        slots.flat[place[earlier]] = element[earlier]
        changed = np.unique(text[earlier])
        latest[changed] = first[changed].max(axis=1)
    return slots


def _band_values(slots: np.ndarray) -> np.ndarray:
    """One number for each band; it also tells which band it is."""
    bands = slots.reshape(len(slots), BANDS, BAND_SLOTS)
    values = np.zeros(bands.shape[:2], np.uint64)
    for i in range(BAND_SLOTS):
        values = _mixed(values * _POWERS[0] + bands[:, :, i] + _STEP)
    return _mixed(values + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)


def _key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("key")


def _signed(texts: DataFrame) -> DataFrame:
    """The columns but ``text``, with ``n`` shingles, ``buckets`` and ``sketch``.

    The sketch has the lowest byte of every slot.
    """
    held: list = []

    def rows(batch):
        if not held:
            held.append(shingler())
        found = [held[0](t) for t in texts_of(batch["text"])]
        slots = signatures([h for h, _ in found], [c for _, c in found])
        values = _band_values(slots)
        sizes = [len(h) for h, _ in found]
        buckets = [v if n else [] for v, n in zip(values, sizes, strict=True)]
        sketches = [s.tobytes() for s in slots.astype(np.uint8)]
        return {"n": sizes, "buckets": buckets, "sketch": sketches}

    schema = "n int, buckets array<long>, sketch binary"
    return map_rows(texts, rows, schema, keep=True).drop("text")


def _sets(texts: DataFrame) -> DataFrame:
    held: list = []

    def rows(batch):
        if not held:
            held.append(shingler())
        found = [held[0](t)[0] for t in texts_of(batch["text"])]
        return {
            "node": batch["node"],
            "shingles": [np.unique(h.astype(np.uint32)).view(np.int32) for h in found],
        }

    return map_rows(texts, rows, "node long, shingles array<int>")


def _similar(a, b):
    """Sizes alone allow the similarity."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose shingle sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    joined = pairs.join(one, "a").join(two, "b")
    return joined.where(both >= SIMILARITY * either).select("a", "b")


def _agreeing(members: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a bucket's members that agree on enough slots.

    ``members`` has ``bucket, size, node, n, root, sketch``. Large buckets are cut
    into blocks and every two blocks meet in a task of their own. A pair comes out of
    the first bucket that both share, and only if the members lie in different
    classes and their sizes allow the similarity.
    """
    blocks = F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    met = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[pdf.own == pdf.low.iloc[0]]
        second = pdf[pdf.own == pdf.high.iloc[0]]
        whole, bands = [], []
        for part in (first, second):
            sketch = np.frombuffer(b"".join(part.sketch), np.uint8).reshape(-1, SLOTS)
            whole.append(sketch)
            bands.append(sketch.view(np.uint64).reshape(-1, BANDS))
        place = pdf.band.iloc[0]
        found = []
        for i in range(len(first)):
            row = first.iloc[i]
            least = np.minimum(second.n.to_numpy(), row.n)
            most = np.maximum(second.n.to_numpy(), row.n)
            fits = (second.root.to_numpy() != row.root) & (least >= SIMILARITY * most)
            if row.own == second.own.iloc[0]:
                fits &= second.node.to_numpy() > row.node
            spots = np.flatnonzero(fits)
            equal = (whole[1][spots] == whole[0][i]).mean(axis=1)
            spots = spots[equal >= LEAST_AGREEMENT]
            shared = bands[1][spots] == bands[0][i]
            spots = spots[~shared[:, :place].any(axis=1)]
            found += [(row.node, n) for n in second.node.to_numpy()[spots]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return met.groupBy("bucket", "low", "high").applyInPandas(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node; the root is the smallest node reached.

    Alternates two steps: each node's larger neighbours, then its smaller ones, are
    tied to its smallest. Neighbours are never gathered into one row.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.where("u <> v").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u")
        large = staged(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(lower.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small, "links")
        reached = _state(edges)
        if reached == state:
            break
        state = reached
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(20, 0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


def classes(documents: DataFrame) -> DataFrame:
    """``key, node, rep, class_id, n_links``: every distinct text and its class.

    ``rep`` is the smallest ``doc_id`` with the text and ``class_id`` the smallest in
    the class.
    """
    texts = documents.select("doc_id", _key(), F.coalesce("text", F.lit("")).alias("text"))
    signed = staged(_signed(texts), "minhash")
    nodes = signed.groupBy("key").agg(
        F.min("doc_id").alias("rep"),
        *(F.first(c).alias(c) for c in ("n", "buckets", "sketch")),
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash")
    entries = nodes.select("node", "n", F.posexplode("buckets").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("company")).where("company > 1")
    members = staged(entries.join(shared, "bucket"), "minhash")
    popular = members.groupBy("node").agg(F.sum("company").alias("popular"))
    ranked = staged(members.drop("company").join(popular, "node"), "minhash")
    leaders = ranked.groupBy("bucket").agg(
        F.max(F.struct("popular", "node", "n")).alias("leader")
    )
    pairs = ranked.join(leaders, "bucket").where(
        (F.col("node") != F.col("leader.node")) & _similar(F.col("n"), F.col("leader.n"))
    )
    pairs = pairs.select(F.col("node").alias("a"), F.col("leader.node").alias("b"))
    pairs = staged(pairs.distinct(), "minhash")
    # Shingle sets of the texts that share a bucket with another.
    wanted = members.select("node").distinct().join(nodes, "node")
    wanted = wanted.select("node", F.col("key").alias("k"), "rep")
    same = (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    chosen = texts.join(wanted, same).select("node", "text")
    sets = staged(_sets(chosen).dropDuplicates(["node"]), "minhash")
    links = staged(_verified(pairs, sets), "minhash")
    roots = components(links)
    # Members of a bucket that are still in different classes.
    rooted = members.select("bucket", "band", "node", "n").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("bucket").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count("*").alias("size"),
    )
    open_buckets = mixed.where("low <> high").select("bucket", "size")
    rest = rooted.join(open_buckets, "bucket").join(nodes.select("node", "sketch"), "node")
    crossing = _agreeing(staged(rest, "minhash"))
    tried = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    crossing = staged(crossing.distinct().join(tried, ["a", "b"], "left_anti"), "minhash")
    more = staged(_verified(crossing, sets), "minhash")
    if not more.isEmpty():
        links = links.union(more)
        roots = components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    placed = nodes.select("key", "node", "rep").join(roots, "node", "left")
    placed = placed.join(degree, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("rep").alias("class_id"))
    whole = placed.join(smallest, "root")
    return whole.select("key", "node", "root", "rep", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, class_id, rep, n_links`` of every document.

    Texts are equal (null counts as empty) or linked by chains of texts of at least
    ``SIMILARITY``. Repeated rows share a class; null ids do not count for
    ``class_id``; an empty table gives no rows.
    """
    found = staged(classes(documents), "minhash").drop("node", "root")
    return (
        documents.select("doc_id", _key())
        .join(found, "key")
        .select("doc_id", "class_id", "rep", "n_links")
    )


def filtered(documents: DataFrame) -> DataFrame:
    """One document of each class, with its own columns only."""
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("llm_row")
    numbered = documents.select(F.col("text"), whole)
    numbered = staged(
        numbered.withColumn("doc_id", F.monotonically_increasing_id()), "minhash"
    )
    found = classes(numbered)
    kept = found.groupBy("root").agg(F.min("rep").alias("doc_id")).select("doc_id")
    return numbered.join(kept, "doc_id", "left_semi").select("llm_row.*")
