"""Exact top-k inner products with vector-approximation files.

Vectors lie in blocks. Beside its exact vectors a block holds their approximation: per component
one of 64 cells, cut at quantiles of the block's own values, and each cell's smallest and largest
value. From cells alone a query's score with a vector is bounded on both sides: the middles of the
cells give a score, their half-widths what it may be off.

The first pass reads cells only and finds, per query, a score that k vectors are sure to reach. The
second reads cells again with that floor, and of the exact vectors only those whose upper bound
reaches it, from the highest bound down, until the kth score found is above the next bound.

Both passes meet blocks of queries with runs of blocks of vectors. What leaves a task is at most k
rows per query and run. Equal vectors are one class with its k smallest ids, so a crowd of copies is
bounded, scored and read once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonal.llm.common import look_up, ship, spread_join
from zonal.operators.staging import stage

# Cells per component; a cell number is a byte.
CELLS = 64

# Vectors of a block, blocks of a run, queries of a block of queries: what a task holds at once.
ROWS = 2048
RUN = 8
QUERIES = 1024

# Exact vectors read at a time.
READ = 32

LARGEST = (1 << 63) - 1

_CLASS = "key binary, dim int, vec binary"


def quantised(vectors: DataFrame, query: Column, scale: int, name: str) -> DataFrame:
    """Written rows of the vectors that take part: vec_id, asks (whether it is a query), key (of
    equal vectors), dim and vec, its components floor(scale * x) as 16-bit integers, or as doubles
    where they need more. `row` tells rows of one id apart."""
    ship(vectors.sparkSession)

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            rows, keys, dims, values = [], [], [], []
            for k, held in enumerate(batch.column(2).to_pylist()):
                if held is None or None in held:
                    continue
                scaled = np.floor(scale * np.array(held, dtype="f8"))
                if not np.isfinite(scaled).all():
                    continue
                small = np.abs(scaled).max(initial=0) < 1 << 15
                data = (scaled + 0.0).astype("<i2" if small else "<f8").tobytes()
                rows.append(k)
                keys.append(xxhash.xxh3_128_digest(data, seed=len(held)))
                dims.append(len(held))
                values.append(data)
            part = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            columns = [*part.columns, pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "asks", "key", "dim", "vec"])

    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.coalesce(query, F.lit(False)).alias("asks"), F.col(name).cast("array<double>")
    ).mapInArrow(run, f"vec_id bigint, asks boolean, {_CLASS}")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()))


def _values(data: bytes, n: int):
    """`n` packed numbers, as they are."""
    return np.frombuffer(data, dtype="<i2" if len(data) == 2 * n else "<f8")


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """One written row per distinct vector: cls, key, dim, vec, and `members`, its `most` smallest
    (none, vec_id, row). Spark keeps no more than that of any vector in a task before it shuffles."""
    order = Window.partitionBy("key").orderBy(F.asc_nulls_last("vec_id"), "row")
    few = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    member = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "row")
    classes = few.groupBy("key").agg(
        F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.sort_array(F.collect_list(member)).alias("members")
    )
    return stage(classes.withColumn("cls", F.monotonically_increasing_id()))


def _build(group):
    """A group of classes to one row: their numbers and first members, cells, cell borders, vectors."""
    import pyarrow as pa

    dim = group.column("dim")[0].as_py()
    packed = group.column("vec").to_pylist()
    exact = np.array([_values(v, dim) for v in packed], dtype="f8").reshape(len(packed), dim)
    order = np.sort(exact, axis=0)
    # a cell begins at every quantile of the component's values; equal quantiles are one border
    starts = order[np.linspace(0, len(order), CELLS, endpoint=False).astype("i8")]
    cells = np.empty(exact.shape, dtype="u1")
    low, high = np.zeros((dim, CELLS)), np.zeros((dim, CELLS))
    for c in range(dim):
        cells[:, c] = np.searchsorted(starts[:, c], exact[:, c], "right") - 1
        first = np.searchsorted(order[:, c], starts[:, c], "left")
        last = np.searchsorted(order[:, c], np.append(starts[1:, c], np.inf), "left") - 1
        low[c], high[c] = starts[:, c], order[np.maximum(first, last), c]
    small = all(len(v) == 2 * dim for v in packed)
    ids = group.column("vec_id")
    row = {
        "dim": dim,
        "cls": group.column("cls").to_numpy().astype("<i8").tobytes(),
        "none": ids.is_null().to_numpy().astype("u1").tobytes(),
        "first": ids.fill_null(LARGEST).to_numpy().astype("<i8").tobytes(),
        "row": group.column("row").to_numpy().astype("<i8").tobytes(),
        "cells": cells.tobytes(),
        "low": low.tobytes(),
        "high": high.tobytes(),
        "exact": exact.astype("<i2" if small else "<f8").tobytes(),
    }
    return pa.table({k: [v] for k, v in row.items()}).select(_BLOCK_COLUMNS).cast(_block_schema())


_BLOCK_COLUMNS = ["dim", "cls", "none", "first", "row", "cells", "low", "high", "exact"]


def _block_schema():
    import pyarrow as pa

    return pa.schema([(c, pa.int32() if c == "dim" else pa.binary()) for c in _BLOCK_COLUMNS])


def vector_file(classes: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Blocks of classes as written rows: dim, run, class numbers and first members, cells, borders
    and exact vectors. `sizes` has dim, n (classes), blocks."""
    placed = look_up(classes, sizes.select("dim", "n", "blocks"), "dim", total)
    block = F.pmod(F.xxhash64(F.lit(3), "cls"), F.col("blocks")).cast("int")
    first = F.get("members", F.lit(0))
    rows = placed.select("dim", block.alias("block"), "cls", "vec", first["vec_id"].alias("vec_id"), first["row"].alias("row"))
    schema = "dim int, " + ", ".join(f"{c} binary" for c in _BLOCK_COLUMNS[1:])
    built = rows.groupBy("dim", "block").applyInArrow(_with_block(_build), f"block int, {schema}")
    return stage(built.withColumn("run", F.floor(F.col("block") / F.lit(RUN)).cast("int")))


def _with_block(build):
    def run(key, group):
        import pyarrow as pa

        made = build(group)
        return made.add_column(0, "block", pa.array([key[1].as_py()], pa.int32()))

    return run


def query_blocks(asked: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Blocks of queries (dim, cls, vec, floor) as written rows: dim, part, numbers, vectors, floors."""
    placed = look_up(asked, sizes.select("dim", F.col("asked").alias("n"), "parts"), "dim", total)
    part = F.pmod(F.xxhash64(F.lit(5), "cls"), F.col("parts")).cast("int")

    def build(key, group):
        import pyarrow as pa

        dim = key[0].as_py()
        values = np.array([_values(v, dim) for v in group.column("vec").to_pylist()], dtype="f8").reshape(len(group), dim)
        row = {
            "dim": pa.array([dim], pa.int32()),
            "part": pa.array([key[1].as_py()], pa.int32()),
            "asking": [group.column("cls").to_numpy().astype("<i8").tobytes()],
            "values": [values.tobytes()],
            "floors": [group.column("floor").to_numpy().tobytes()],
        }
        return pa.table(row)

    rows = placed.select("dim", part.alias("part"), "cls", "vec", "floor")
    return stage(rows.groupBy("dim", "part").applyInArrow(build, "dim int, part int, asking binary, values binary, floors binary"))


def _asked(left):
    dim = left.column("dim")[0].as_py()
    asking = np.frombuffer(left.column("asking")[0].as_py(), dtype="<i8")
    values = np.frombuffer(left.column("values")[0].as_py()).reshape(len(asking), dim)
    return asking, values, np.frombuffer(left.column("floors")[0].as_py())


def _bounds(values, block, side: int):
    """Lower (side -1) or upper (side 1) bounds of the scores of queries with the vectors of a
    block, from cells alone: what their middles give, and what the cells' halves may add."""
    dim, n = values.shape[1], len(block["cls"]) // 8
    low, high = (np.frombuffer(block[c]).reshape(dim, CELLS) for c in ("low", "high"))
    cells = np.frombuffer(block["cells"], dtype="u1").reshape(n, dim)
    largest = dim * np.abs(values).max(initial=0) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    if not largest < 1e300:
        return np.full((len(values), n), side * 2.0**63)
    at = np.arange(dim)
    middle = values @ ((low + high) / 2)[at, cells].T
    reach = np.abs(values) @ ((high - low) / 2)[at, cells].T
    # halves of integers add up without error while they are small
    room = 0 if largest < 1 << 51 else largest * 1e-13
    return np.clip(middle + side * (reach + room), -(2.0**63), 2.0**63)


def _exact(query, vectors):
    """Integer inner products, held within 64 bits."""
    vectors = vectors.astype("f8")
    largest = len(query) * np.abs(query).max(initial=0) * np.abs(vectors).max(initial=0)
    if largest < 1 << 53:
        return (vectors @ query).astype("i8")
    whole = [int(q) for q in query]
    sums = (sum(int(v) * q for v, q in zip(vector, whole)) for vector in vectors)
    return np.array([max(-LARGEST - 1, min(LARGEST, s)) for s in sums], dtype="i8")


def _blocks(right):
    for k in range(len(right)):
        yield {c: right.column(c)[k].as_py() for c in right.column_names}


def floors(most: int):
    """First pass over a run: per query the score that `most` of the run's vectors are sure to reach."""

    def run(left, right):
        import pyarrow as pa

        names, held = [], []
        if len(left) and len(right):
            asking, values, _ = _asked(left)
            best = np.full((len(asking), most), -np.inf)
            for block in _blocks(right):
                best = np.concatenate([best, _bounds(values, block, -1)], axis=1)
                best = np.partition(best, best.shape[1] - most, axis=1)[:, -most:]
            names, held = asking, best.min(axis=1)
        return pa.table({"asking": pa.array(names, pa.int64()), "floor": pa.array(held, pa.float64())})

    return run


def readings(most: int):
    """Second pass over a run: the best `most` vectors of each query, and in `n_read` how many exact
    vectors were read for it."""

    def run(left, right):
        import pyarrow as pa

        out = {c: [] for c in ("asking", "score", "none", "first", "row", "cls", "n_read")}
        if len(left) and len(right):
            asking, values, least = _asked(left)
            held = [tuple(np.zeros(0, "i8") for _ in range(5)) for _ in asking]
            least, reads = least.copy(), np.zeros(len(asking), dtype="i8")
            for block in _blocks(right):
                names = [np.frombuffer(block[c], dtype="u1" if c == "none" else "<i8") for c in ("none", "first", "row", "cls")]
                shape = len(names[0]), values.shape[1]
                exact = _values(block["exact"], shape[0] * shape[1]).reshape(shape)
                upper = _bounds(values, block, 1)
                for q in np.flatnonzero((upper >= least[:, None]).any(axis=1)):
                    open_ = np.flatnonzero(upper[q] >= least[q])
                    open_ = open_[np.argsort(-upper[q, open_], kind="stable")]
                    for first in range(0, len(open_), READ):
                        some = open_[first : first + READ]
                        some = some[upper[q, some] >= least[q]]
                        if not len(some):
                            break
                        score = _exact(values[q], exact[some])
                        reads[q] += len(some)
                        good = score >= least[q]
                        if not good.any():
                            continue
                        found = [score[good], *[n[some[good]] for n in names]]
                        both = [np.concatenate(x) for x in zip(held[q], found)]
                        order = np.lexsort((both[3], both[2], both[1], ~both[0]))[:most]
                        held[q] = tuple(b[order] for b in both)
                        if len(order) == most:
                            least[q] = max(least[q], held[q][0][-1])
            sizes = [len(h[0]) for h in held]
            out["asking"], out["n_read"] = np.repeat(asking, sizes), np.repeat(reads, sizes)
            for k, c in enumerate(("score", "none", "first", "row", "cls")):
                out[c] = np.concatenate([h[k] for h in held]).astype("i8")
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def search(vectors: DataFrame, k: int = 20, query: Column | None = None, scale: int = 64, name: str = "embedding") -> DataFrame:
    """The `k` best rows for every query row: query_id, rank (from 1), vec_id, score.

    `vectors` has vec_id and the vector; `query` says which rows ask, by default those whose id is
    divisible by 20. All other rows are candidates, with as many components as the query. A
    component x counts as floor(scale * x); the score is the inner product of those integers, held
    within 64 bits. Equal scores go by the smaller vec_id, NULL last. Vectors that are NULL, or hold
    a NULL or a component that is not finite (once scaled), take no part; empty ones score 0 with
    each other. Rows that repeat an id are rows each: a row leaves out itself alone. Without
    candidates a query has no rows. Other columns are not read."""
    query = F.col("vec_id") % 20 == 0 if query is None else query
    most = k + 1  # a query's own row may be among them
    rows = quantised(vectors, query, scale, name)
    classes = classes_of(rows, most)
    asks = rows.where("asks")
    counted = asks.groupBy("key").agg(F.count(F.lit(1)).alias("n_asking"))
    asked = stage(classes.join(counted, "key").select("cls", "key", "dim", "vec", "n_asking"))
    of_asked = asked.groupBy("dim").agg(F.count(F.lit(1)).alias("asked"))
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).join(of_asked, "dim", "left").fillna(0, "asked")
    blocks = F.ceil(F.col("n") / F.lit(ROWS)).cast("int")
    parts = F.ceil(F.col("asked") / F.lit(QUERIES)).cast("int")
    runs = F.ceil(blocks / F.lit(RUN)).cast("int")
    sizes = stage(sizes.select("dim", "n", "asked", blocks.alias("blocks"), parts.alias("parts"), runs.alias("runs")))
    total = classes.count()
    file = vector_file(classes, sizes, total)
    n_file, n_asked = file.count(), asked.count()
    every = F.explode(F.when(F.col("parts") > 0, F.sequence(F.lit(0), F.col("parts") - 1)))
    per_dim = sizes.select("dim", F.col("blocks").alias("n"), "parts")
    meeting = look_up(file, per_dim, "dim", n_file)
    at = ["dim", "part", "run"]

    def meet(run, asked: DataFrame, columns: list[str], schema: str) -> DataFrame:
        left = query_blocks(asked, sizes, n_asked)
        left = look_up(left, sizes.select("dim", F.col("parts").alias("n"), "runs"), "dim", left.count())
        left = left.withColumn("run", F.explode(F.sequence(F.lit(0), F.col("runs") - 1))).drop("runs")
        right = meeting.withColumn("part", every).select(*at, *columns)
        return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(run, schema)

    blind = asked.withColumn("floor", F.lit(float("-inf")))
    low = meet(floors(most), blind, ["cls", "cells", "low", "high"], "asking bigint, floor double")
    low = low.groupBy("asking").agg(F.max("floor").alias("floor"))
    knowing = stage(asked.join(low.withColumnRenamed("asking", "cls"), "cls"))
    schema = "asking bigint, score bigint, none bigint, first bigint, row bigint, cls bigint, n_read bigint"
    found = meet(readings(most), knowing, _BLOCK_COLUMNS[1:], schema)
    best = Window.partitionBy("asking").orderBy(F.desc("score"), "none", "first", "row")
    near = stage(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most).select("asking", "score", "cls"))

    # from classes back to rows: members of the found ones, then every row that asks
    members = spread_join(near, classes.select("cls", "members"), "cls", "asking", near.count())
    members = members.select("asking", "score", F.inline("members"))
    order = Window.partitionBy("asking").orderBy(F.desc("score"), "none", "vec_id", "row")
    ranked = members.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    entry = F.struct("nth", "row", "vec_id", "score")
    lists = ranked.groupBy("asking").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    lists = asked.join(lists.withColumnRenamed("asking", "cls"), "cls").select("key", F.col("n_asking").alias("n"), "entries")
    asks = asks.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "key")
    answered = look_up(asks, stage(lists), "key", asks.count())
    others = F.slice(F.filter("entries", lambda e: e["row"] != F.col("own")), 1, k)
    out = answered.select("query_id", F.posexplode(others).alias("pos", "e"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "e.vec_id", "e.score")
