"""Sharding: a uniform shuffle with exact shard sizes.

How many rows each part of the input sends to each shard is drawn first, as one matrix from
the multivariate hypergeometric law: the law of the counts in a uniform permutation. Given the
matrix, a random order inside each part says which rows go where, and a random order inside
each shard says in which slot they end. Together the two make every permutation equally likely,
and no shard is a row too long or too short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonal.llm.common import draw, free_name, with_row_id

# Rows of one slice of a shard, ordered by one task.
SLICE_ROWS = 50_000


def hypergeometric(rng, good: int, bad: int, taken: int) -> int:
    """How many of `taken` balls out of `good` + `bad` are good. Exact inversion over the
    weights around the mode, for any size: weights further out than 40 standard deviations are
    below the smallest float."""
    import numpy as np

    low, high = max(0, taken - bad), min(good, taken)
    if low == high:
        return low
    mode = int((good + 1) * (taken + 1) // (good + bad + 2))
    mean_part = good / (good + bad)
    spread = (taken * mean_part * (1 - mean_part)) ** 0.5
    reach = int(40 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype="float64")
    steps = np.log((good - k) * (taken - k)) - np.log((k + 1) * (bad - taken + k + 1))
    weights = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(weights - weights.max())
    total = np.cumsum(weights)
    return first + int(np.searchsorted(total, rng.random() * total[-1], "right"))


def communication_matrix(rows_of: list[int], rows_to: list[int], seed: int) -> list[list[int]]:
    """Random counts with the given sums per row and per column."""
    import numpy as np

    rng = np.random.Generator(np.random.Philox(seed))
    left = list(rows_to)
    matrix = []
    for n in rows_of:
        sent = []
        rest, pool = n, sum(left)
        for size in left:
            k = hypergeometric(rng, size, pool - size, rest) if rest else 0
            sent.append(k)
            rest, pool = rest - k, pool - size
        left = [a - b for a, b in zip(left, sent)]
        matrix.append(sent)
    return matrix


def place(ids: DataFrame, row: str, shards: int, seed: int) -> DataFrame:
    """Row numbers to (row, shard, slot). `ids` has unique numbers and a fixed content."""
    parts = max(shards, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = F.pmod(F.xxhash64(F.lit(seed), row), F.lit(parts)).cast("int")
    cells = ids.select(row, part.alias("part"))
    # one count per part: as many rows as the session has shuffle partitions
    sizes = dict(tuple(r) for r in cells.groupBy("part").count().collect())
    total = sum(sizes.values())
    rows_to = [(total + shards - 1 - s) // shards for s in range(shards)]
    order = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in order], rows_to, seed)
    bounds = []
    for p, sent in zip(order, matrix):
        upto = 0
        for shard, k in enumerate(sent):
            if k:
                bounds.append((p, shard, upto, upto + k))
            upto += k
    spark = ids.sparkSession
    sends = spark.createDataFrame(bounds, "part int, shard int, first bigint, last bigint")
    sends = sends.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("first", "last", "shard"))).alias("sends"))
    inside = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), row), row)
    drawn = cells.withColumn("turn", (F.row_number().over(inside) - 1).cast("bigint"))
    # parts x shards entries, fixed by the session's settings
    drawn = drawn.join(F.broadcast(sends), "part")
    mine = F.filter("sends", lambda s: (s["first"] <= F.col("turn")) & (F.col("turn") < s["last"]))
    drawn = drawn.select(row, F.element_at(mine, 1)["shard"].alias("shard"))

    slices = max(1, -(-rows_to[0] // SLICE_ROWS)) if total else 1
    u = draw(seed + 2, row)
    drawn = drawn.withColumn("u", u).withColumn("slice", F.floor(F.col("u") * F.lit(slices)).cast("int"))
    counts = drawn.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "slice", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    nearby = Window.partitionBy("shard", "slice").orderBy("u", row)
    slotted = drawn.withColumn("turn", F.row_number().over(nearby) - 1)
    slotted = slotted.join(bases, ["shard", "slice"])
    return slotted.select(row, "shard", (F.col("base") + F.col("turn")).cast("bigint").alias("slot"))


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """Every row of `docs` with `shard` (0 to shards - 1; sizes at most one apart) and `slot`
    (gapless from 0 inside the shard), a uniform random permutation fixed by the seed and by
    the rows as they are stored. Names that are taken get an underscore.

    All rows count, whatever they hold: NULLs, repeated rows and empty texts are rows like any
    other. No rows: no rows. Fewer rows than shards leave the last shards empty."""
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    held, row = with_row_id(docs)
    placed = place(held.select(F.col(row).alias("placed_row")), "placed_row", shards, seed)
    placed = placed.select(F.col("placed_row").alias(row), F.col("shard").alias(shard), F.col("slot").alias(slot))
    return held.join(placed, row).drop(row)


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 1) -> None:
    """Write the shuffled rows below `path`, one folder per shard, each file a run of slots in
    order; a shard is written by as many tasks as it has slices."""
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    rows = shuffle_into_shards(docs, shards, seed)
    rows = rows.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)
    rows.write.mode("errorifexists").partitionBy(shard).parquet(path)
