"""Tiles as runs of equal cells, and their algebra without unfolding them.

A tile is an array of runs [i0, i1) with a value, in row-major order; cells without data are in no
run. Two tiles are merged like sorted lists: the ends of all runs cut the tile into pieces on which
both are constant. A piece costs the same whatever its length, so the work grows with the number
of runs. Both tiles lie in one row, and are merged and joined again inside it: nothing is sent or
sorted. Where runs begin and end is found by Arrow functions over the tiles of a batch, and what
becomes of the values is Spark's own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonal.functions.grid import KEY
from zonal.operators.layers import ROWS_PER_TASK
from zonal.operators.staging import group_sizes, spread_join, stage


def _arrow_functions():
    """Functions of Arrow arrays: the runs of cells, the pieces of two tiles, and runs whose equal
    neighbours are made one. They lie in here, so that they travel to
    the tasks as they are: executors need not have this package."""
    import numpy as np
    import pyarrow.compute as pc

    def listed(rows, lists, **columns):
        """An Arrow array of lists of structs, NULL where `lists` is, from columns of them and the list of each."""
        offsets = np.searchsorted(rows, np.arange(len(lists) + 1)).astype("int32")
        made = pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns))
        return pa.ListArray.from_arrays(pa.array(offsets), made, mask=lists.is_null())

    def unlisted(lists):
        """The elements of an Arrow array of lists, the number of the list that each is in, and its place there."""
        rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype("int64")
        first = np.searchsorted(rows, np.arange(len(lists)))
        return pc.list_flatten(lists), rows, np.arange(len(rows)) - first[rows]

    def like_the_one_before(values, rows):
        """Whether an element equals the one before it in its list; a NaN equals a NaN, and NULL a NULL."""
        none = values.is_null().to_numpy(zero_copy_only=False)
        held = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
        same = np.zeros(len(rows), bool)
        equal = (held[1:] == held[:-1]) | ((held[1:] != held[1:]) & (held[:-1] != held[:-1]))
        same[1:] = equal & (none[1:] == none[:-1]) & (rows[1:] == rows[:-1])
        return same, none

    def in_slices(find):
        """`find` over slices of tiles with about a million elements together: its working memory."""

        @functools.wraps(find)
        def over(*lists):
            elements = max(x.nbytes for x in lists) // 4
            step = max(1, (len(lists[0]) << 20) // max(elements, 1))
            parts = [find(*[x.slice(k, step) for x in lists]) for k in range(0, max(len(lists[0]), 1), step)]
            return pa.concat_arrays(parts)

        return over

    @in_slices
    def runs_of(cells: pa.Array) -> pa.Array:
        values, rows, at = unlisted(cells)
        same, none = like_the_one_before(values, rows)
        starts = np.flatnonzero(~same)
        lasts = np.append(starts[1:], len(rows))[: len(starts)] - 1
        keep = ~none[starts]
        starts, lasts = starts[keep], lasts[keep]
        first, last = at[starts].astype("int32"), (at[lasts] + 1).astype("int32")
        return listed(rows[starts], cells, i0=first, i1=last, v=values.take(pa.array(starts)))

    def ends_of(runs):
        return [runs.field(name).to_numpy(zero_copy_only=False).astype("int64") for name in ("i0", "i1")]

    @in_slices
    def pieces(a: pa.Array, b: pa.Array) -> pa.Array:
        sides, wide = [], 1
        for lists in (a, b):
            runs, rows, _ = unlisted(lists)
            first, last = ends_of(runs)
            wide = max(wide, int(last.max(initial=0)) + 1)
            sides.append((first, last, rows, runs.field("v")))
        # tiles one after another on one axis
        sides = [(first + rows * wide, last + rows * wide, v) for first, last, rows, v in sides]
        cuts = np.unique(np.concatenate([x for first, last, _ in sides for x in (first, last)]))
        begin, end = cuts[:-1], cuts[1:]
        held = []
        for first, last, _ in sides:
            run = np.searchsorted(first, begin, "right") - 1
            found = run >= 0
            found[found] = last[run[found]] > begin[found]
            held.append(np.where(found, run, -1))
        keep = (held[0] >= 0) | (held[1] >= 0)
        rows = begin[keep] // wide
        i0, i1 = [(x[keep] - rows * wide).astype("int32") for x in (begin, end)]
        values = [v.take(pa.array(run[keep], mask=run[keep] < 0)) for run, (_, _, v) in zip(held, sides)]
        return listed(rows, a, i0=i0, i1=i1, a=values[0], b=values[1])

    @in_slices
    def joined_runs(lists: pa.Array) -> pa.Array:
        runs, rows, _ = unlisted(lists)
        first, last = ends_of(runs)
        same, _ = like_the_one_before(runs.field("v"), rows)
        same[1:] &= last[:-1] == first[1:]
        starts = np.flatnonzero(~same)
        lasts = np.append(starts[1:], len(rows))[: len(starts)] - 1
        i0, i1 = first[starts].astype("int32"), last[lasts].astype("int32")
        return listed(rows[starts], lists, i0=i0, i1=i1, v=runs.field("v").take(pa.array(starts)))

    return runs_of, pieces, joined_runs


_runs_of, _pieces, _joined_runs = _arrow_functions()


def to_runs(cells: Column, of: str = "int") -> Column:
    """An array of cells of the type `of` to its runs."""
    return F.arrow_udf(_runs_of, f"array<struct<i0:int,i1:int,v:{of}>>")(cells)


def to_cells(runs: Column, size: int) -> Column:
    """Runs back to an array of `size` cells."""
    nothing = F.lit(None).cast("int")
    ends = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["i1"]))

    def stretch(run: Column, before: Column) -> Column:
        gap = F.array_repeat(nothing, F.coalesce(run["i0"], F.lit(size)) - before)
        return F.when(run.isNull(), gap).otherwise(F.concat(gap, F.array_repeat(run["v"], run["i1"] - run["i0"])))

    # the ends are one more than the runs: the last one begins the gap up to the end of the tile
    return F.flatten(F.zip_with(runs, ends, stretch))


def _value_type(tiles: DataFrame, name: str) -> str:
    return tiles.schema[name].dataType.elementType["v"].dataType.simpleString()


def _met(tiles: DataFrame, a: str, b: str) -> Column:
    """The array of pieces (i0, i1, a, b) of the tiles in columns `a` and `b`."""
    types = f"a:{_value_type(tiles, a)},b:{_value_type(tiles, b)}"
    none = F.array().cast(tiles.schema[a].dataType)
    # the list of the first is NULL where its tile is missing, and the other may still have data
    return F.arrow_udf(_pieces, f"array<struct<i0:int,i1:int,{types}>>")(F.coalesce(F.col(f"`{a}`"), none), F.col(f"`{b}`"))


def merged(tiles: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Pieces on which the tiles in columns `a` and `b` are constant: by, i0, i1 and both values,
    NULL for no data. Pieces without data in both are left out."""
    return tiles.select(*by, F.inline(_met(tiles, a, b)).alias("i0", "i1", a, b))


def pieces_of(tiles: DataFrame, by: list[str], name: str) -> DataFrame:
    """The runs of one tile as rows: by, i0, i1, v."""
    return tiles.select(*by, F.inline(name))


def joined(made: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows (by, i0, i1, v) of an array of runs, with neighbours of one value made one run."""
    found = F.arrow_udf(_joined_runs, f"array<struct<i0:int,i1:int,v:{_value_type(made, name)}>>")(F.col(f"`{name}`"))
    return made.select(*by, F.inline(found))


def collected(pieces: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows (by, i0, i1, v) back to one array of runs per tile, which has no more of them than cells."""
    return pieces.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("i0", "i1", "v"))).alias(name))


def _worked_out(
    tiles: DataFrame, by: list[str], a: str, b: str, keep: Callable[[Column], Column], value: Callable[[Column], Column]
) -> DataFrame:
    """Runs of `value` where two tiles' pieces (a, b) are to be kept."""
    made = F.transform(F.filter(_met(tiles, a, b), keep), lambda p: F.struct(p["i0"].alias("i0"), p["i1"].alias("i1"), value(p).alias("v")))
    return joined(tiles.select(*by, made.alias("made")), by, "made")


def _in_both(p: Column) -> Column:
    return p["a"].isNotNull() & p["b"].isNotNull()


def multiply(tiles: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Runs of the product; no data where either has none."""
    return _worked_out(tiles, by, a, b, _in_both, lambda p: p["a"] * p["b"])


def greater(tiles: DataFrame, by: list[str], name: str, threshold: float) -> DataFrame:
    """Runs of 1 where the value is above the threshold and 0 where it is not."""

    def over(r: Column) -> Column:
        return F.struct(r["i0"].alias("i0"), r["i1"].alias("i1"), (r["v"] > F.lit(threshold)).cast("int").alias("v"))

    return joined(tiles.select(*by, F.transform(F.col(f"`{name}`"), over).alias("made")), by, "made")


def mask(tiles: DataFrame, by: list[str], name: str, other: str) -> DataFrame:
    """Runs of a tile where the other has data."""
    return _worked_out(tiles, by, name, other, _in_both, lambda p: p["a"])


def mask_by_value(tiles: DataFrame, by: list[str], name: str, other: str, value: int) -> DataFrame:
    """Runs of a tile where the other does not equal `value`."""

    def kept(p: Column) -> Column:
        return p["a"].isNotNull() & ~p["b"].eqNullSafe(F.lit(value))

    return _worked_out(tiles, by, name, other, kept, lambda p: p["a"])


def criterion(tiles: DataFrame, by: list[str], value: str, other: str, threshold: float) -> DataFrame:
    """Runs of 1 where `value` > 0 and `other` > threshold, else 0; no data where either has none.
    One merge: no tile of either condition is made."""
    return _worked_out(tiles, by, value, other, _in_both, lambda p: ((p["a"] > 0) & (p["b"] > F.lit(threshold))).cast("int"))


def largest(runs: Column) -> Column:
    """The largest value of a tile."""
    return F.array_max(F.transform(runs, lambda r: r["v"]))


def cell_counts(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Cells with data and their sum per tile, from rows of runs."""
    length = (F.col("i1") - F.col("i0")).cast("bigint")
    return pieces.groupBy(*by).agg(F.sum(length * F.col("v")).alias("total"), F.sum(length).alias("n"))


def masked_by_coverage(
    cells: DataFrame, tiles: DataFrame, by: list[str], name: str, at: tuple[str, ...] = KEY, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Runs of a tile under the coverage rows of its key: `runs` of covered cells, and the tile in
    column `name`, its runs or its cells. `by` tells coverage rows apart. Cells in buckets of `at` stay
    where they are: they stream past hash tables of the coverage and become runs after that, as no
    Arrow function keeps buckets. No side is broadcast."""
    cells = stage(cells)
    hint = "merge" if tuple(at) == tuple(KEY) else "shuffle_hash"
    met = spread_join(cells, tiles, group_sizes(cells, list(at)), list(at), by, rows_per_task, hint)
    held = tiles.schema[name].dataType.elementType
    if not isinstance(held, T.StructType):
        met = met.withColumn(name, to_runs(F.col(f"`{name}`"), held.simpleString()))
    covered = F.transform("runs", lambda r: F.struct(r["i0"].alias("i0"), r["i1"].alias("i1"), F.lit(1).alias("v")))
    return mask(met.withColumn("covered", covered), by, name, "covered")
