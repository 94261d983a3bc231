"""Clustering by centroids with equal-average equal-variance search.

Vectors are integers after scaling, so every distance, sum and centroid is exact and the same on
any partitioning. For a vector and a centroid of d components the squared distance is at least
d * (difference of means)**2 + (difference of deviations)**2, a deviation being the norm of the
vector less its mean. Centroids lie sorted by mean. A vector starts at its own mean and goes
outwards, always to the nearer mean; when the means alone lie further apart than the best distance
so far, all that is left lies further still. A centroid that the means do not reject is tried by
the deviations, and only what passes both is measured, in integers.

Centroids are a parameter's worth of rows: `k` times the dimensions is checked against a bound.
They travel with the tasks; the vectors stay where they are, and a task sends one sum per centroid.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import ship
from zonal.operators.staging import stage

# Most numbers that all centroids together may have (32 MB).
MAX_CENTROID_NUMBERS = 1 << 22

LARGEST = (1 << 63) - 1

# Rows of a batch that are searched together.
ROWS = 4096


def integer_vectors(vectors: DataFrame, scale: int, dims: int, name: str = "embedding") -> DataFrame:
    """Written rows (vec_id, vec) of the vectors with exactly `dims` components, all of them finite;
    a component is floor(scale * x), held within 64 bits."""
    held = F.col(name).cast("array<double>")
    finite = F.forall(held, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.col(name).isNotNull()).where((F.size(name) == dims) & finite)
    scaled = F.transform(held, lambda x: F.floor(F.lit(float(scale)) * x))
    return stage(kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("vec")))


def narrow(d: int) -> int:
    """Up to this size of `d` components a squared distance fits 64 bits. Larger ones are worked
    on as Python integers."""
    return math.isqrt((1 << 61) // max(1, d))


class Centroids:
    """Centroids (a list of lists of integers, by number) in the order of their means."""

    def __init__(self, values: list[list[int]]):
        self.wide = wide = any(abs(x) > narrow(len(row)) for row in values for x in row)
        self.values = np.array(values, dtype=object if wide else "i8").reshape(len(values), -1)
        means, spreads = moments(self.values)
        self.number = np.argsort(means, kind="stable")
        self.values, self.mean, self.spread = self.values[self.number], means[self.number], spreads[self.number]

    def nearest(self, x):
        """Number of the nearest centroid of each row (the smaller of two as near), its squared
        distance, and how many distances were measured in all."""
        if self.wide or np.abs(x.astype("f8")).max(initial=0) > narrow(x.shape[1]):
            x = x.astype(object)
        values = self.values.astype(object) if x.dtype == object else self.values
        rows, d = x.shape
        k = len(values)
        mean, spread = moments(x)
        best = np.full(rows, LARGEST if x.dtype != object else None)
        bound = np.full(rows, np.inf)
        number = np.full(rows, k)
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        going, measured = np.arange(rows), 0
        while len(going):
            to_left = np.where(left[going] >= 0, mean[going] - self.mean[left[going]], np.inf)
            inside = right[going] < k
            to_right = np.where(inside, self.mean[np.minimum(right[going], k - 1)] - mean[going], np.inf)
            turn = to_left <= to_right
            apart = np.where(turn, to_left, to_right)
            at = np.where(turn, left[going], np.minimum(right[going], k - 1))
            # bounds are floating-point: give them the room that rounding could take
            room = 1e-12 * (d * (np.abs(mean[going]) + np.abs(self.mean[at])) ** 2 + (spread[going] + self.spread[at]) ** 2)
            near = np.isfinite(apart)
            near[near] = (d * apart**2 - room)[near] <= bound[going][near]
            going, at, turn, apart, room = (v[near] for v in (going, at, turn, apart, room))
            left[going[turn]] -= 1
            right[going[~turn]] += 1
            close = d * apart**2 + (spread[going] - self.spread[at]) ** 2 - room <= bound[going]
            tried, at = going[close], at[close]
            measured += len(tried)
            step = x[tried] - values[at]
            distance = (step * step).sum(axis=1)
            name = self.number[at]
            first = ~np.isfinite(bound[tried])
            better = first.copy()
            old = ~first
            better[old] = (distance[old] < best[tried[old]]) | ((distance[old] == best[tried[old]]) & (name[old] < number[tried[old]]))
            won = tried[better]
            best[won], number[won] = distance[better], name[better]
            bound[won] = distance[better].astype("f8")
        return number, best, measured


def moments(x):
    """Mean and deviation (the norm of what differs from the mean) of each row."""
    values = x.astype("f8")
    mean = values.mean(axis=1) if x.shape[1] else np.zeros(len(x))
    return mean, np.sqrt(((values - mean[:, None]) ** 2).sum(axis=1))


def _matrix(column, dims: int):
    """Rows of an Arrow column of integer lists, all of them `dims` long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The `k` vectors with the smallest SHA-256 of `seed:vec_id`; fewer if there are fewer. A NULL
    id counts as an empty one, and equal ids go by their vectors."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name.cast("binary"), 256).alias("hash"), "vec").orderBy("hash", "vec").limit(k)
    return [list(row["vec"]) for row in rows.collect()]  # k rows


def moved(kept: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Centroids after one round: the floor of the mean of what lies nearest, component by
    component; a centroid that nothing lies nearest to stays."""
    found = Centroids(centroids)

    def run(batches):
        import pyarrow as pa

        sums, counts = {}, {}
        for batch in batches:
            whole = _matrix(batch.column(0), dims)
            for first in range(0, len(whole), ROWS):
                x = whole[first : first + ROWS]
                number, _, _ = found.nearest(x)
                wide = np.abs(x.astype("f8")).max(initial=0) > 1 << 48
                for c in np.unique(number).tolist():
                    own = x[number == c].astype(object if wide else "i8").sum(axis=0)
                    sums[c] = sums.get(c, 0) + own.astype(object)
                    counts[c] = counts.get(c, 0) + int((number == c).sum())
        names = list(sums)
        totals = [[Decimal(int(v)) for v in sums[c]] for c in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), pa.array([counts[c] for c in names], pa.int64()), pa.array(totals, pa.list_(pa.decimal128(38, 0)))],
            ["cluster", "n", "sums"],
        )

    parts = kept.select("vec").mapInArrow(run, "cluster int, n bigint, sums array<decimal(38,0)>")
    terms = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "total"))
    rows = terms.groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = [list(c) for c in centroids]
    for cluster, pos, n, total in rows.collect():  # one row per number of the centroids
        out[cluster][pos] = int(total) // n
    return out


def assign(kept: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """vec_id, cluster and distance (squared, held within 64 bits) of every vector."""
    found = Centroids(centroids)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            whole = _matrix(batch.column(1), dims)
            for first in range(0, len(whole), ROWS):
                number, distance, _ = found.nearest(whole[first : first + ROWS])
                held = np.minimum(distance, LARGEST).astype("i8")
                ids = batch.column(0).slice(first, ROWS)
                yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype("i4")), pa.array(held)], ["vec_id", "cluster", "distance"])

    return kept.select("vec_id", "vec").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def fit(kept: DataFrame, k: int, rounds: int, dims: int, seed: int) -> list[list[int]]:
    """Centroids after `rounds` rounds."""
    if k < 1 or k * dims > MAX_CENTROID_NUMBERS:
        raise ValueError(f"k must be at least 1 and k * dims at most {MAX_CENTROID_NUMBERS}")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids, dims)
    return centroids


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, seed: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The assignment (vec_id, cluster, distance), and the centroids (cluster, centroid).

    `vectors` has vec_id and embedding; other columns are not read. Vectors that are NULL, of
    another length, or hold a NULL or non-finite component take no part. Vectors as near to two
    centroids go to the smaller number. Repeated rows are vectors each; a NULL id is kept, and
    counts as an empty one where ids are hashed. With fewer vectors than `k` there are as many
    centroids; with none, no rows."""
    ship(vectors.sparkSession)
    kept = integer_vectors(vectors, scale, dims)
    centroids = fit(kept, k, rounds, dims, seed)
    table = vectors.sparkSession.createDataFrame([(i, c) for i, c in enumerate(centroids)], "cluster int, centroid array<bigint>")
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), table
    return stage(assign(kept, centroids, dims)), table


def digest(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """Assignments with the inertia of their cluster and of all, and a digest of the centroid. The
    table that is joined has a row per centroid."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per_cluster = assigned.groupBy("cluster").agg(exact.alias("inertia")).collect()
    sums = {row["cluster"]: int(row["inertia"]) for row in per_cluster}
    whole = min(LARGEST, sum(sums.values()))

    def name(values):
        return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()

    rows = [(c, min(LARGEST, sums.get(c, 0)), name(v)) for c, v in centroids.collect()]
    facts = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    joined = assigned.join(F.broadcast(facts), "cluster").withColumn("inertia", F.lit(whole).cast("bigint"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
