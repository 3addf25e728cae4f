"""Clusters around centroids, searched through a VA-file.

Vectors become integers, ``floor(256 * x)`` a component. The start centroids are the
vectors whose ids have the smallest hashes; each round assigns every vector to the
nearest centroid (ties: the smaller number) and replaces a centroid by the rounded
down mean of its vectors; an empty one stays. All arithmetic is exact.

Method: the index holds 4 bits a component, the cell of the value among 16, two to a
byte. For one round each (byte, centroid) has a least and a greatest part of the
squared distance, in tables of 256 rows; summed over a vector's bytes they give an
interval for each centroid. A centroid whose interval begins behind the end of
another one is out. If one is left it is the nearest without a look at the vector;
only where intervals overlap are the full components read and compared.

Scale: index and vectors are written once; a round is one pass without a shuffle of
vectors and adds up components by cluster inside each task, so ``centroids`` rows a
task are exchanged. The driver holds the centroids and a sample. Cell limits are
quantiles of the ``SAMPLE_ROWS`` vectors with the smallest hashes of the id (a bound
on the fit of the index; any limits give the same result, only other intervals), the
outer cells end at the least and greatest value of all vectors.

Odd rows: vectors without exactly ``dimensions`` components, or with null or
non-finite ones, are left out. Integers stop at 2^27 either way, as squared distances
would leave the long range. A null id hashes as empty text. Repeated rows count each.
With fewer vectors than centroids every vector starts one. No vectors, no rows. Other
columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged

CENTROIDS = 40
DIMENSIONS = 64
ROUNDS = 5
SCALE = 256
SEED = 2
SAMPLE_ROWS = 4096
CELLS = 16
LIMIT = 1 << 27
#: Sums of so large squares are exact in doubles, which multiply faster.
EXACT = 1 << 20

RESULT = "vec_id {id}, cluster int, distance long"


def _vectors(embeddings: DataFrame, dimensions: int, seed: int) -> DataFrame:
    """Id, hash of the id, and integer components of the usable vectors."""
    usable = (F.size("embedding") == dimensions) & F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )

    def whole(x):
        scaled = F.floor(x.cast("double") * SCALE)
        return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), scaled)).cast("int")

    name = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    return embeddings.filter(usable).select(
        "vec_id",
        F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("rank"),
        F.transform("embedding", whole).alias("vector"),
    )


def _first_vectors(vectors: DataFrame, count: int) -> list:
    """(rank, vector, copies) of the smallest hashes, ``SAMPLE_ROWS`` at most.

    A threshold on the hash leaves about that many rows before any are sorted; it
    rises when repeated ids leave too few.
    """
    share = SAMPLE_ROWS / max(count, 1)
    while True:
        near = vectors
        if share < 1:
            near = vectors.filter(F.col("rank") < f"{int(share * 16**12):012x}")
        found = (
            near.groupBy("rank", "vector")
            .count()
            .orderBy("rank", "vector")
            .limit(SAMPLE_ROWS)
            .collect()
        )
        if share >= 1 or sum(row["count"] for row in found) >= SAMPLE_ROWS / 2:
            return found
        share *= 8


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _ranges(vectors: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each component, one row a task combined by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column(0), dimensions)
                lows, highs = values.min(axis=0), values.max(axis=0)
                low = lows if low is None else np.minimum(low, lows)
                high = highs if high is None else np.maximum(high, highs)
        if low is not None:
            places = np.arange(dimensions, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(low), pa.array(high)],
                names=["place", "low", "high"],
            )

    found = (
        vectors.select("vector")
        .mapInArrow(run, "place int, low int, high int")
        .groupBy("place")
        .agg(F.min("low"), F.max("high"))
        .orderBy("place")
        .collect()
    )
    return np.array([r[1] for r in found]), np.array([r[2] for r in found])


def cell_limits(sample: np.ndarray) -> np.ndarray:
    """For each component the first value of every cell but the lowest."""
    shares = np.arange(1, CELLS) / CELLS
    return np.ceil(np.quantile(sample, shares, axis=0)).astype(np.int64).T


def cells_of(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Two cells to a byte, for each vector."""
    cells = np.empty(values.shape, dtype=np.uint8)
    for place, first in enumerate(limits):
        cells[:, place] = np.searchsorted(first, values[:, place], side="right")
    if cells.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    return cells[:, ::2] << 4 | cells[:, 1::2]


def interval_tables(
    centroids: np.ndarray, limits: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest part of the squared distance by (byte, value, centroid)."""
    first = np.concatenate([np.minimum(low, limits[:, 0])[:, None], limits], axis=1)
    last = np.concatenate([limits - 1, np.maximum(high, limits[:, -1])[:, None]], axis=1)
    at = centroids.T[:, None, :]
    under, over = first[:, :, None] - at, at - last[:, :, None]
    least = np.maximum(np.maximum(under, over), 0) ** 2
    greatest = np.maximum(np.abs(under), np.abs(over)) ** 2
    if len(limits) % 2:
        none = np.zeros((1, *least.shape[1:]), dtype=least.dtype)
        least, greatest = (np.concatenate([t, none]) for t in (least, greatest))

    def paired(table: np.ndarray) -> np.ndarray:
        both = table[::2, :, None, :] + table[1::2, None, :, :]
        return both.reshape(len(both), CELLS * CELLS, -1)

    return paired(least), paired(greatest)


def distances(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, exact."""
    largest = max(np.abs(values).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if largest <= EXACT else np.int64
    values, centroids = values.astype(kind), centroids.astype(kind)
    squares = (values * values).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)
    return (squares - 2 * (values @ centroids.T)).astype(np.int64)


class Search:
    """Nearest centroids of one round; built in each task from a few numbers."""

    def __init__(self, centroids, limits, low, high):
        self.centroids = centroids
        self.least, self.greatest = interval_tables(centroids, limits, low, high)

    def nearest(self, cells: np.ndarray, vectors) -> tuple[np.ndarray, int]:
        """Cluster of each vector, and how many vectors had to be read.

        ``vectors`` gives the full components of the chosen rows.
        """
        lower = np.zeros((len(cells), len(self.centroids)), dtype=np.int64)
        upper = np.zeros_like(lower)
        for place in range(cells.shape[1]):
            lower += self.least[place][cells[:, place]]
            upper += self.greatest[place][cells[:, place]]
        possible = lower <= upper.min(axis=1, keepdims=True)
        cluster = possible.argmax(axis=1)
        open_rows = np.flatnonzero(possible.sum(axis=1) > 1)
        if len(open_rows):
            exact = distances(vectors(open_rows), self.centroids)
            cluster[open_rows] = exact.argmin(axis=1)
        return cluster, len(open_rows)


class VectorIndex:
    """Approximations and full vectors of all rows, and what reads them."""

    def __init__(self, embeddings: DataFrame, dimensions: int, seed: int):
        self.dimensions = dimensions
        vectors = staged(_vectors(embeddings, dimensions, seed), "vectors")
        self.count = vectors.count()
        if self.count == 0:
            self.rows = vectors
            return
        self.sample = _first_vectors(vectors, self.count)
        sample = np.array([row["vector"] for row in self.sample], dtype=np.int64)
        self.limits = cell_limits(sample)
        self.low, self.high = (x.astype(np.int64) for x in _ranges(vectors, dimensions))
        limits = self.limits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = _matrix(batch.column("vector"), dimensions)
                packed = cells_of(values, limits)
                cells = pa.array([row.tobytes() for row in packed], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), cells, batch.column("vector")],
                    names=["vec_id", "cells", "vector"],
                )

        kind = vectors.schema["vec_id"].dataType.simpleString()
        self.rows = staged(
            vectors.select("vec_id", "vector").mapInArrow(
                run, f"vec_id {kind}, cells binary, vector array<int>"
            ),
            "cells",
        )

    def first(self, centroids: int) -> np.ndarray:
        """The vectors of the smallest hashes."""
        found = []
        for row in self.sample:
            found += [row["vector"]] * min(row["count"], centroids - len(found))
        return np.array(found, dtype=np.int64)

    def _search(self, centroids: np.ndarray):
        """A function of a task's batches: (batch, values, cluster, rows read)."""
        limits, low, high = self.limits, self.low, self.high
        dimensions = self.dimensions

        def run(batches: Iterator[pa.RecordBatch]):
            search = Search(centroids, limits, low, high)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                packed = b"".join(batch.column("cells").to_pylist())
                cells = np.frombuffer(packed, np.uint8).reshape(batch.num_rows, -1)
                values = _matrix(batch.column("vector"), dimensions)
                yield batch, values, *search.nearest(cells, values.__getitem__)

        return run

    def updated(self, centroids: np.ndarray) -> tuple[np.ndarray, int]:
        """The centroids after one round, and how many vectors had to be compared."""
        search, number, width = self._search(centroids), len(centroids), self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((number, width), dtype=np.int64)
            sizes = np.zeros(number, dtype=np.int64)
            read = 0
            for _, values, cluster, looked_at in search(batches):
                order = np.argsort(cluster, kind="stable")
                present, starts = np.unique(cluster[order], return_index=True)
                grouped = values[order].astype(np.int64)
                sums[present] += np.add.reduceat(grouped, starts, axis=0)
                sizes += np.bincount(cluster, minlength=number)
                read += looked_at
            reads = [read, *[0] * (number - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, dtype=np.int32)),
                    pa.array(sizes),
                    pa.array(reads, pa.int64()),
                    pa.array(sums.tolist(), pa.list_(pa.int64())),
                ],
                names=["cluster", "size", "read", "sums"],
            )

        parts = self.rows.mapInArrow(
            run, "cluster int, size long, read long, sums array<long>"
        )
        sums = [F.sum(F.col("sums")[i]) for i in range(width)]
        found = parts.groupBy("cluster").agg(
            F.sum("size").alias("size"),
            F.sum("read").alias("read"),
            F.array(*sums).alias("sums"),
        )
        after, read = centroids.copy(), 0
        for row in found.collect():
            read += row["read"]
            if row["size"]:
                after[row["cluster"]] = [s // row["size"] for s in row["sums"]]
        return after, read

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """vec_id, cluster and squared distance of every vector."""
        search = self._search(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, values, cluster, _ in search(batches):
                apart = values.astype(np.int64) - centroids[cluster]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        pa.array(cluster.astype(np.int32)),
                        pa.array((apart * apart).sum(axis=1)),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

        kind = self.rows.schema["vec_id"].dataType.simpleString()
        return self.rows.mapInArrow(run, RESULT.format(id=kind))


def cluster(
    embeddings: DataFrame,
    centroids: int = CENTROIDS,
    dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of every usable vector, and the centroids."""
    index = VectorIndex(embeddings, dimensions, seed)
    if index.count == 0:
        none = index.rows.select(
            "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")
        )
        return none, np.zeros((0, dimensions), dtype=np.int64)
    found = index.first(centroids)
    for _ in range(rounds):
        found, _ = index.updated(found)
    return staged(index.assigned(found), "assigned"), found


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the sums of distances and the digest of the row's centroid.

    One row a centroid is summed up, brought to the driver and joined as it is.
    """
    sums = {
        row["cluster"]: row["inertia"]
        for row in assigned.groupBy("cluster")
        .agg(F.sum("distance").alias("inertia"))
        .collect()
    }
    rows = [
        (number, sums.get(number, 0), digest(centroid))
        for number, centroid in enumerate(centroids)
    ]
    named = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        "centroid_sha256",
    )
