"""Source mixing and centroid clustering against SQL and brute force."""

import random

import __spark_entry__
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference, plan, sql_rows

from siltstone.llm import centroid_clustering, source_mixing
from siltstone.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_tables_equal_sql(spark, sf_dir, name):
    result = __spark_entry__.queries()[name](spark, sf_dir)
    found = (result.columns, [tuple(r) for r in result.collect()])
    assert found[1]
    assert difference(found, sql_rows(connect(sf_dir), ORACLES[name])) is None


def in_sql(name, table, columns, kinds):
    given = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                     names=table[1])
    connection = duckdb.connect()
    connection.register(table[0], given)
    return sql_rows(connection, ORACLES[name])


# 12

DOCUMENTS = "doc_id long, source string, text string, size string, bucket int, target string"


def text_of(rng, words):
    return " ".join(rng.choice(["one", "two#", "<b>", "word", "ü"]) for _ in range(words))


def uneven_documents():
    """A hot source, tiny sources that stop at their cap, odd and repeated rows."""
    rng = random.Random(3)
    rows = [(i, "hot", text_of(rng, rng.randrange(60))) for i in range(900)]
    for number in range(12):
        rows += [
            (1000 + 50 * number + i, f"s{number}", text_of(rng, rng.randrange(1 + 3 * number)))
            for i in range(20)
        ]
    rows += [(5000 + i, "big", text_of(rng, 4000)) for i in range(3)]
    rows += [(6000, None, text_of(rng, 30)), (None, None, "no id"), (6001, "", None)]
    rows += [(6002, "\U0001f600", "astral"), (6003, "￿", "below astral words")]
    rows += [(7000, "hot", "the same row many times")] * 40
    rows += [(7001, "empty", ""), (7002, "empty", " \t\n")]
    return rows


def mixed(spark, rows):
    given = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCUMENTS)
    return source_mixing.mix(given)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_mix_equals_sql(spark, monkeypatch, buckets):
    monkeypatch.setattr(source_mixing, "BUCKETS", buckets)
    rows = uneven_documents()
    result = mixed(spark, rows)
    found = (result.columns, [tuple(r) for r in result.collect()])
    expected = in_sql(
        "op12_source_mixing",
        ("documents", ["doc_id", "source", "text"]),
        list(zip(*rows, strict=True)),
        [pa.int64(), pa.string(), pa.string()],
    )
    assert difference(found, expected) is None


def test_sources_take_their_targets(spark):
    rows = uneven_documents()
    source_of = {r[0]: r[1] for r in rows}
    found = mixed(spark, rows).collect()
    taken, target = {}, {}
    for row in found:
        source = source_of[row["doc_id"]]
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[source] = taken.get(source, 0) + row["taken"]
        target[source] = row["target"]
        assert row["target"] <= 3 * row["source_size"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)
    total = sum(row["size"] for row in found)
    assert sum(target.values()) == pytest.approx(total)
    assert any(target[s] == 3 * sum(r["size"] for r in found if source_of[r["doc_id"]] == s)
               for s in ("s1", "s2"))


def test_better_documents_are_likelier(spark):
    """Words in a third of all rows are taken by weight, not evenly."""
    rows = [(i, "a", "word " * 40) for i in range(2000)]
    rows += [(2000 + i, "a", "#### " * 40) for i in range(2000)]
    rows += [(9000 + i, "b", "word " * 40) for i in range(2000)]
    found = mixed(spark, rows).collect()
    good = sum(r["taken"] for r in found if r["doc_id"] < 2000)
    poor = sum(r["taken"] for r in found if 2000 <= r["doc_id"] < 4000)
    assert good > 1.5 * poor > 0


@pytest.mark.parametrize("total", [2**31 // 3 + 1, 2**31 - 1, 2**31 + 5, 10**12])
def test_targets_of_many_words(spark, total):
    """Words that fit an int while their product with a weight does not, and more."""
    small = total // 1000
    sizes = {"a": total // 2, "b": total // 3, "c": small}
    sizes["d"] = total - sum(sizes.values())
    given = spark.createDataFrame([*sizes.items()], "source string, source_size long")
    found = {r["source"]: r["target"] for r in source_mixing.targets(given).collect()}
    rest = total - 3 * small
    assert found == {"a": rest / 4, "b": rest * 2 / 4, "c": 3.0 * small, "d": rest / 4}


def test_mix_plan_is_native(spark):
    result = mixed(spark, uneven_documents()[:200])
    assert "Python" not in plan(result)
    assert "NestedLoop" not in plan(result)


def test_mix_of_nothing(spark):
    assert mixed(spark, []).collect() == []
    found = mixed(spark, [(1, "a", ""), (2, None, None)]).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2


# 13

EMBEDDINGS = "vec_id long, embedding array<float>, label int, cluster string, rank int"


def odd_vectors(n=400, scale=1.0):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, 64))
    rows = []
    for i in range(n):
        vector = middles[i % 12] + 0.3 * rng.normal(size=64)
        rows.append((i, [float(np.float32(x * scale)) for x in vector]))
    bad = [list(rows[0][1]) for _ in range(3)]
    bad[0][5], bad[1][6], bad[2][7] = None, float("nan"), float("inf")
    rows += [(n + i, v) for i, v in enumerate(bad)]
    rows += [(n + 10, None), (n + 11, []), (n + 12, [1.0] * 63), (n + 13, [1.0] * 65)]
    rows += [(n + 20 + i, rows[7][1]) for i in range(150)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2) for r in rows], EMBEDDINGS)


def brute(rows, k=40, rounds=5):
    import hashlib
    import math

    kept = [
        (i, np.array([math.floor(256 * x) for x in v], dtype=object))
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = {i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    order = sorted(kept, key=lambda r: (name[r[0]], list(r[1])))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n)
                   for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(m[d] for m in members) // len(members) for d in range(64)]
    return sorted((str(i), *nearest(v)) for i, v in kept)


def found_clusters(spark, rows):
    assigned, centroids = centroid_clustering.cluster(frame(spark, rows))
    result = centroid_clustering.with_inertia(assigned, centroids).collect()
    sums = {}
    for r in result:
        sums[r["cluster"]] = sums.get(r["cluster"], 0) + r["distance"]
    for r in result:
        assert r["cluster_inertia"] == sums[r["cluster"]]
        assert r["inertia"] == sum(sums.values())
        assert r["centroid_sha256"] == centroid_clustering.digest(centroids[r["cluster"]])
    return sorted((str(r["vec_id"]), r["distance"], r["cluster"]) for r in result)


@pytest.mark.parametrize("scale", [1.0, 0.01, 5e4])
def test_clusters_equal_brute_force(spark, scale):
    rows = odd_vectors(150, scale)
    assert found_clusters(spark, rows) == brute(rows)


def test_few_vectors_and_repeated_ids(spark):
    rows = [(1, [float(i)] * 64) for i in range(3)] + [(None, [9.0] * 64)] * 2
    rows += [(2, [0.5] * 64)] * 60
    assert found_clusters(spark, rows) == brute(rows)
    assert found_clusters(spark, rows[:2]) == brute(rows[:2])


def test_huge_components_stop(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 64) for i in range(6)]
    found = found_clusters(spark, rows)
    assert [r[1] for r in found] == [0] * 6


def test_no_vectors(spark):
    rows = [(1, None), (2, [float("nan")] * 64)]
    assert found_clusters(spark, rows) == []
    assert found_clusters(spark, []) == []


def test_intervals_hold_and_spare_most_vectors():
    rng = np.random.default_rng(2)
    middles = rng.integers(-400, 400, size=(40, 64))
    values = middles[rng.integers(0, 40, 3000)] + rng.integers(-60, 60, size=(3000, 64))
    limits = centroid_clustering.cell_limits(values)
    cells = centroid_clustering.cells_of(values, limits)
    low, high = values.min(axis=0), values.max(axis=0)
    search = centroid_clustering.Search(middles, limits, low, high)
    exact = centroid_clustering.distances(values, middles)
    lower = sum(search.least[p][cells[:, p]] for p in range(cells.shape[1]))
    upper = sum(search.greatest[p][cells[:, p]] for p in range(cells.shape[1]))
    assert (lower <= exact).all() and (exact <= upper).all()
    cluster, read = search.nearest(cells, values.__getitem__)
    assert (cluster == exact.argmin(axis=1)).all()
    assert read < len(values) / 2


def test_ties_take_the_smaller_number():
    values = np.zeros((4, 64), dtype=np.int64)
    centroids = np.array([[2] * 64, [-2] * 64, [2] * 64])
    limits = centroid_clustering.cell_limits(values)
    search = centroid_clustering.Search(centroids, limits, values[0], values[0])
    cells = centroid_clustering.cells_of(values, limits)
    cluster, _ = search.nearest(cells, values.__getitem__)
    assert list(cluster) == [0] * 4


def test_large_squares_are_exact():
    limit = centroid_clustering.LIMIT
    values = np.array([[limit] * 64, [-limit] * 64])
    found = centroid_clustering.distances(values, values)
    assert found.tolist() == [[0, 64 * (2 * limit) ** 2], [64 * (2 * limit) ** 2, 0]]
