"""Joining raster layers to keys and to coverage.

A tile table is long (key_col, key_row, layer, cells) or stacked (one row per key, a column per
layer, see `zonal.sources.stacks`). Keys are plain ints, so every spatial join here is an
equi-join. Joins of long tiles carry a sort-merge hint: a tile column compresses so well that its
file size says nothing about its size in memory, and the automatic broadcast goes by file size.
Stacked tiles stay where they are stored, and the coverage comes to them.

Which tiles a set of keys can use is answered by a map of bits, one word for every 64 segments of
a file. Its size is bounded by the grid and not by the keys, so it is always broadcast; where the
table is partitioned by file, the files it names are the only ones listed and read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonal.functions.grid import KEY, Grid
from zonal.operators.coverage import LOC, coverage_cells, segment_cover
from zonal.operators.staging import group_sizes, more_tasks, sent, spread_join, stage

# Coverage rows of one segment that one task may work through before the segment is split.
ROWS_PER_TASK = 256

# Cells of tiles and coverage rows that one task of a join of long tiles holds: 64 MB of them.
CELLS_PER_TASK = 1 << 24

# Most bits of a segment map: 262,144 words, some 20 MB as a hash relation. The 6.5 million segments
# of the default grid have a bit each; on finer grids a bit stands for a square of segments.
MAP_BITS = 1 << 24


def layer_tiles(tiles: DataFrame, layer: str) -> DataFrame:
    """Tiles of one layer with the cells in a column of that name."""
    return tiles.where(F.col("layer") == layer).select(*KEY, F.col("cells").alias(layer))


def join_layers(keys: DataFrame, tiles: DataFrame, layers: list[str], how: str = "left", tasks: int = 0) -> DataFrame:
    """Stack layers beside `keys`, one array column per layer, NULL where a tile is missing. All are
    joined in the same `tasks` tasks, if a number is given."""
    stacked = sent(keys, list(KEY), tasks)
    for layer in layers:
        stacked = stacked.join(sent(layer_tiles(tiles, layer), list(KEY), tasks).hint("merge"), list(KEY), how)
    return stacked


def join_tasks(sizes: DataFrame, layers: int, grid: Grid) -> int:
    """Tasks for a join of coverage with long tiles of some layers, from the written rows per key: a
    key has a tile of each layer, and a coverage row has no more runs than a tile has cells. 0 where
    the session has enough."""
    found = sizes.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    return more_tasks(sizes.sparkSession, (found["keys"] * layers + (found["rows"] or 0)) * grid.cells, CELLS_PER_TASK)


def explode_runs(df: DataFrame, layers: list[str], keep: list[str]) -> DataFrame:
    """One row per cell of the runs in `runs`, with `cell` and the layers' values there.

    The tiles are first cut to each run, then the cut is unfolded, so a row on its way
    carries one run of cells and never a whole tile. Both steps are generators over plain
    columns: they stay inside the join's generated code.
    """
    runs = df.select(*keep, *layers, F.inline("runs").alias("i0", "i1"))
    first, length = F.col("i0") + F.lit(1), F.col("i1") - F.col("i0")
    cuts = runs.select(*keep, "i0", length.alias("length"), *[F.slice(c, first, length).alias(c) for c in layers])
    numbered = cuts.select(*keep, "i0", *layers, F.explode(F.sequence(F.lit(0), F.col("length") - F.lit(1))).alias("j"))
    return numbered.select(
        *keep, (F.col("i0") + F.col("j")).alias("cell"), *[F.get(c, F.col("j")).alias(c) for c in layers]
    )


def explode_tiles(df: DataFrame, layers: list[str], grid: Grid) -> DataFrame:
    """One row per cell of the stacked tiles; a missing tile gives NULL cells."""
    rows = F.array(
        *[
            F.struct(F.lit(r * grid.block).alias("i0"), F.lit((r + 1) * grid.block).alias("i1"))
            for r in range(grid.block)
        ]
    )
    keep = [c for c in df.columns if c not in layers]
    return explode_runs(df.withColumn("runs", rows), layers, keep)


def _square(grid: Grid) -> int:
    """Segments along the side of the square that one bit stands for."""
    across = grid.file_px // grid.block
    return -(-across // min(across, math.isqrt(max(1, MAP_BITS // grid.file_count))))


def _place(df: DataFrame, grid: Grid) -> DataFrame:
    """Add the place of a key's bit: file_row and file_col where they are not there, word and bit."""
    across, square = grid.file_px // grid.block, _square(grid)
    side = -(-across // square)
    for name, key in (("file_row", "key_row"), ("file_col", "key_col")):
        if name not in df.columns:
            df = df.withColumn(name, grid.file_of_key(F.col(key)))

    def inside(key: str) -> Column:
        return F.floor(F.pmod(F.col(key), F.lit(across)) / F.lit(square)).cast("int")

    at = inside("key_row") * F.lit(side) + inside("key_col")
    return df.withColumn("word", F.shiftright(at, 6)).withColumn("bit", at.bitwiseAND(63))


def segment_map(keys: DataFrame, grid: Grid) -> DataFrame:
    """The bits of some segment keys, as written rows of file_row, file_col, word and bits."""
    one = F.expr("shiftleft(1L, bit)")
    placed = _place(keys.select(*KEY), grid)
    return stage(placed.groupBy("file_row", "file_col", "word").agg(F.bit_or(one).alias("bits")))


def pruned_tiles(tiles: DataFrame, keys: DataFrame, grid: Grid, exact: bool = False) -> DataFrame:
    """Only tiles whose key is among `keys`, as far as the bits can tell: exactly so on the default
    grid, and on finer ones up to a square of segments. `exact` makes sure of the rest by a join; a
    join on the keys that follows anyway does as well. In a table partitioned by file no other file
    is read."""
    bits = F.broadcast(segment_map(keys, grid).where(F.col("bits") != 0))
    met = _place(tiles, grid).join(bits, ["file_row", "file_col", "word"])
    found = met.where(F.expr("bits & shiftleft(1L, bit)") != 0).select(*tiles.columns)
    return found.join(keys.select(*KEY).distinct(), list(KEY), "left_semi") if exact and _square(grid) > 1 else found


def area_tiles(tiles: DataFrame, locations: DataFrame, grid: Grid, aoi_id: int = -1) -> DataFrame:
    """Tiles of the segments touched by the area-of-interest locations."""
    area = locations.where(F.col("location_id") == aoi_id)
    return pruned_tiles(tiles, stage(segment_cover(area, grid).select(*KEY).distinct()), grid, exact=True)


def locations_with_tiles(
    cells: DataFrame, tiles: DataFrame, layer: str, grid: Grid, rows_per_task: int = ROWS_PER_TASK, how: str = "inner"
) -> DataFrame:
    """Coverage rows with the tile of a layer. Rows whose tile is missing are left out, or kept with
    a NULL tile by `how="left"`."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    cells = stage(cells)
    sizes = group_sizes(cells, list(KEY))
    tasks = join_tasks(sizes, 1, grid)
    held = layer_tiles(pruned_tiles(tiles, sizes, grid), layer).where(F.col(layer).isNotNull())
    met = spread_join(cells, held, sizes, list(KEY), list(LOC), rows_per_task, tasks=tasks)
    if how == "inner":
        return met
    alone = sent(cells, list(KEY), tasks).join(sent(held.select(*KEY), list(KEY), tasks), list(KEY), "left_anti")
    nothing = F.lit(None).cast(held.schema[layer].dataType).alias(layer)
    return met.unionByName(alone.select(*cells.columns, nothing))


def spatial_join(
    locations: DataFrame, tiles: DataFrame, grid: Grid, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Location x tile pairs that intersect, as an equi-join on touched segments."""
    cells = stage(segment_cover(locations, grid))
    sizes = group_sizes(cells, list(KEY))
    return spread_join(cells, pruned_tiles(tiles, sizes, grid), sizes, list(KEY), list(LOC), rows_per_task)


def is_stacked(tiles: DataFrame) -> bool:
    return "layer" not in tiles.columns


def covered_values(
    locations: DataFrame,
    tiles: DataFrame,
    layers: list[str],
    grid: Grid,
    rule: str = "center",
    required: str | None = None,
    carry: dict | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per covered pixel with its location, key, cell number and layer values.

    Long tiles are stacked once per key, stacked ones are taken as they are; then the coverage meets
    them, so a tile is read once however many locations share it. Segments crowded with locations
    are split over several tasks. With `required`, pixels of keys lacking that layer are left out.
    `carry` adds columns computed once per coverage row instead of once per pixel.
    """
    cells = stage(coverage_cells(locations, grid, rule))
    return values_of(cells, tiles, layers, grid, required, carry, rows_per_task)


def values_of(
    cells: DataFrame,
    tiles: DataFrame,
    layers: list[str],
    grid: Grid,
    required: str | None = None,
    carry: dict | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`covered_values` of written coverage rows."""
    keep = [*LOC, *KEY, *(carry or {})]
    cells = cells.select(*LOC, *KEY, "runs", *[column.alias(name) for name, column in (carry or {}).items()])
    if is_stacked(tiles):
        return explode_runs(meet_stacked(cells, tiles, layers, grid, required, rows_per_task), layers, keep)
    keys = group_sizes(cells, list(KEY))
    low = keys.agg(*[f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in KEY]).first()
    for k in KEY:  # these reach the scan as literals; without keys they are NULL, and so is every comparison
        tiles = tiles.where(F.col(k).between(F.lit(low[f"min_{k}"]), F.lit(low[f"max_{k}"])))
    tasks = join_tasks(keys, len(layers), grid)
    stack = join_layers(keys.select(*KEY), pruned_tiles(tiles, keys, grid), layers, tasks=tasks)
    if required is not None:
        stack = stack.where(F.col(required).isNotNull())
    met = spread_join(cells, stack, keys, list(KEY), list(LOC), rows_per_task, tasks=tasks)
    return explode_runs(met, layers, keep)


def meet_stacked(
    cells: DataFrame, stack: DataFrame, layers: list[str], grid: Grid, required: str | None, rows_per_task: int
) -> DataFrame:
    """Coverage rows with the layers of their key from a stacked table. The stored stack is neither
    shuffled nor sorted: it streams past hash tables of the coverage, which was sent to the bucket
    of its segment. A key with more rows than a task should hold is dealt out apart. Keys without a
    stack keep their rows, with NULL layers, unless some layer is `required`."""
    placed = cells.withColumn("segment", grid.segment(F.col("key_col"), F.col("key_row")))
    sizes = group_sizes(placed, ["segment"])
    low = sizes.agg(F.min("segment").alias("first"), F.max("segment").alias("last")).first()
    held = stack.where(F.col("segment").between(F.lit(low["first"]), F.lit(low["last"]))).select("segment", *layers)
    if required is not None:
        held = held.where(F.col(required).isNotNull())
    met = spread_join(placed, held, sizes, ["segment"], list(LOC), rows_per_task, hint="shuffle_hash")
    if required is not None:
        return met.drop("segment")
    alone = placed.join(held.select("segment"), "segment", "left_anti")
    nothing = [F.lit(None).cast(stack.schema[c].dataType).alias(c) for c in layers]
    return met.unionByName(alone.select(*placed.columns, *nothing)).drop("segment")
