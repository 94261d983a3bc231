"""Vector search and clustering against brute force, with odd vectors, ties, copies and empty tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonal.llm import centroids, vector_search
from zonal.operators.staging import stage

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n, dim=8, seed=3, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], 0) for i in range(n)]


ODD = [
    (1000, None, 1), (1001, [1.0, None] + [0.0] * 6, 1), (1002, [float("nan")] + [0.0] * 7, 1), (1003, [float("inf")] * 8, None),
    (1004, [], 1), (1020, [], 1), (None, [0.5] * 8, 1), (None, None, None), (1040, [0.5] * 8, 1), (1040, [0.5] * 8, 1),
    (1060, [2.0, 1.0], 2), (1061, [1.0, 1.0], 2), (1080, [1e30] * 8, 2), (1081, [-0.0] * 8, 2), (1100, [0.0] * 8, 2),
]


def brute_search(rows, k=20, scale=64):
    kept = []
    for number, (i, v, _) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((number, i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    out = []
    for n, i, q in kept:
        if i is None or i % 20:
            continue
        others = []
        for m, j, v in kept:
            if m != n and len(v) == len(q):
                score = max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v))))
                others.append((-score, j is None, j or 0, j))
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(sorted(others, key=lambda e: e[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [vectors(400) + ODD, vectors(150, spread=0.02) + [(500 + i, [0.25] * 8, 0) for i in range(120)]])
def test_search_is_brute_force(spark, rows, monkeypatch):
    """Several blocks, runs and query blocks; close scores; a crowd of copies that all ask."""
    for name, value in (("ROWS", 40), ("RUN", 2), ("QUERIES", 7)):
        monkeypatch.setattr(vector_search, name, value)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "cls", "key", "dim", "n", "rank")})
    for k in (20, 1):
        found = vector_search.search(table, k=k)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted([tuple(r) for r in found.collect()], key=str) == brute_search(rows, k)


def test_search_reads_few_exact_vectors(spark):
    rows = spark.createDataFrame(vectors(3000, dim=32, spread=0.2), SCHEMA)
    file = vector_search.classes_of(vector_search.quantised(rows, F.col("vec_id") < 50, 64, "embedding"), 21)
    group = file.select("dim", "cls", "vec", F.get("members", F.lit(0))["vec_id"].alias("vec_id"), F.lit(0).cast("bigint").alias("row")).toArrow()
    block = vector_search._build(group)
    asked = file.where("cls < 50").select("cls", "vec").collect()
    values = np.array([vector_search._values(r["vec"], 32) for r in asked], dtype="f8")
    left = {"dim": [32], "asking": [np.arange(len(asked)).astype("<i8").tobytes()], "values": [values.tobytes()], "floors": [np.full(len(asked), -np.inf).tobytes()]}
    import pyarrow as pa

    found = vector_search.floors(21)(pa.table(left), block.select(["cls", "cells", "low", "high"]))
    exact = np.array([vector_search._values(r["vec"], 32) for r in file.select("vec").collect()], dtype="f8")
    kth = np.sort(exact @ values.T, axis=0)[-21]
    assert (found.column("floor").to_numpy() <= kth).all()
    left["floors"] = [found.column("floor").to_numpy().tobytes()]
    read = vector_search.readings(21)(pa.table(left), block)
    assert max(read.column("n_read").to_pylist()) < 0.25 * len(exact)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_search.search(none).collect() == []
    assert vector_search.search(spark.createDataFrame(ODD[:4], SCHEMA)).collect() == []
    assert vector_search.search(spark.createDataFrame([(20, [1.0], 0)], SCHEMA)).collect() == []


def brute_clusters(rows, k, rounds, scale=256, dims=64, seed=2):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [max(-(2**63), min(2**63 - 1, int(np.floor(scale * float(np.float32(x)))))) for x in v]))
    named = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    found = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(found))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        found = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(found)]
    ends = [(i, *nearest(v)) for i, v in kept]
    top = 2**63 - 1
    own = {}
    for _, d, n in ends:
        own[n] = own.get(n, 0) + min(d, top)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    whole = min(top, sum(own.values()))
    return sorted([(i, n, min(d, top), min(top, own[n]), whole, digests[n]) for i, d, n in ends], key=str)


@pytest.mark.parametrize(("k", "rounds", "extra"), [(7, 5, []), (40, 2, [(9000, [1e25] * 6, 0), (9001, [-3e20] + [1.0] * 5, 0)]), (3, 0, [])])
def test_clusters_are_brute_force(spark, k, rounds, extra):
    """Copies of one vector, equal centroids, NULL ids, other lengths, and vectors beyond 64 bits."""
    rows = vectors(120, dim=6) + [(300 + i, [0.5] * 6, 0) for i in range(60)] + [(None, [0.1] * 6, None), (7, [0.1] * 6, 0)] + ODD + extra
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("vec", "cluster", "distance", "hash")})
    found = centroids.digest(*centroids.cluster(table, k=k, rounds=rounds, dims=6))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute_clusters(rows, k, rounds, dims=6)


def test_clusters_of_few_and_none(spark):
    rows = vectors(3, dim=6)
    found = centroids.digest(*centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=40, dims=6))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute_clusters(rows, 40, 5, dims=6)
    assert centroids.digest(*centroids.cluster(spark.createDataFrame([], SCHEMA), dims=6)).collect() == []
    with pytest.raises(ValueError, match="k must be"):
        centroids.fit(stage(spark.createDataFrame([], "vec_id bigint, vec array<bigint>")), 0, 1, 6, 2)


def test_inequalities_spare_distances():
    rng = np.random.default_rng(5)
    spots = rng.integers(-4000, 4000, (50, 1)) + rng.integers(-300, 300, (50, 16))
    x = spots[rng.integers(0, 50, 2000)] + rng.integers(-20, 20, (2000, 16))
    found = centroids.Centroids(spots.tolist())
    number, distance, measured = found.nearest(x)
    whole = ((x[:, None, :] - spots[None]) ** 2).sum(axis=2)
    assert (distance == whole.min(axis=1)).all() and (number == whole.argmin(axis=1)).all()
    assert measured < 0.2 * whole.size
