"""Which pixels a polygon covers, as a relational job.

A location is one or more polygon parts (shell ring first, then holes). In every pixel
row the edges of a part are crossed at some columns, and the part covers what lies
between an odd crossing and the next: holes come out of that, and so do rings that
cross themselves, whatever their orientation. The spans of all parts are then steps
of a difference array, +1 at their start and -1 at their end, whose running total
along the row is the number of parts covering a pixel. Nothing is gathered per
location: steps are summed before the shuffle and a row holds at most one per column.
Pixel rows of edges are counted first, and the tasks of all exchanges grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonal.functions.grid import KEY, Grid
from zonal.operators.staging import more_tasks, sent, spread, stage

LOC = ("list_id", "location_id")
# `slot` stands for a share of the parts of a location: what happens per slot needs no exchange
PART = (*LOC, "slot", "part", "band")
SLOTS = 64
RULES = ("center", "all_touched")

# Rows of one piece of an edge where segments do not give it.
BAND = 512

# Range of location ids that share one row of a cell map.
MAP_ENTRIES = 64

# Runs of cells that one task gathers into cell maps: some 40 MB of them.
RUNS_PER_TASK = 1 << 20

# Pixel rows of edges that one task works through.
ROWS_PER_TASK = 1 << 18


def polygon_edges(locations: DataFrame, scale_x, scale_y) -> DataFrame:
    """One row per polygon edge in grid units: x1, y1, x2, y2, and `part`, which tells the parts
    of a location apart. Copies of a part collapse to one before the shuffle."""

    def scaled(p: Column) -> Column:
        return F.struct(scale_x(p["x"]).alias("x"), scale_y(p["y"]).alias("y"))

    parts = locations.select(*LOC, "rings").distinct()
    # 128 bits, and the same on every attempt of a task
    part = F.struct(F.xxhash64("rings").alias("low"), F.xxhash64(F.lit(1), "rings").alias("high"))
    rings = parts.select(*LOC, part.alias("part"), F.explode("rings").alias("ring"))
    rings = rings.where(F.size("ring") > 2).select(*LOC, "part", F.transform("ring", scaled).alias("ring"))
    # closing a closed ring again only adds an empty edge
    ends = F.concat(F.slice("ring", 2, F.size("ring") - 1), F.slice("ring", 1, 1))
    rings = rings.withColumn("edges", F.arrays_zip("ring", ends.alias("ends")))
    return rings.select(*LOC, "part", F.inline("edges").alias("a", "b")).select(
        *LOC,
        "part",
        F.col("a.x").alias("x1"),
        F.col("a.y").alias("y1"),
        F.col("b.x").alias("x2"),
        F.col("b.y").alias("y2"),
    )


def edge_rows(edges: DataFrame, height: int) -> int:
    """Pixel rows that all edges together pass through, about."""
    rows = F.coalesce(F.least(F.abs(F.col("y2") - F.col("y1")), F.lit(float(height))), F.lit(0.0)) + 1
    return int(edges.agg(F.sum(rows)).first()[0] or 0)


def spread_edges(edges: DataFrame, band: int = BAND, rows: int = 0) -> DataFrame:
    """Prepare edges for expansion into rows: ends ordered by y, so two polygons sharing an
    edge compute the same crossings; long edges listed once per band of rows; equal ones once,
    with `n`, how often the part runs along them. All that follows for a part and band happens
    where its edges were sent, and the bands of a big polygon land on all tasks, however few
    files or rows it came in. There are as many tasks as the `rows` of pixels ask for."""
    flip = (F.col("y1") > F.col("y2")) | ((F.col("y1") == F.col("y2")) & (F.col("x1") > F.col("x2")))
    ordered = edges.select(
        *LOC,
        "part",
        F.when(flip, F.col("x2")).otherwise(F.col("x1")).alias("xt"),
        F.when(flip, F.col("y2")).otherwise(F.col("y1")).alias("yt"),
        F.when(flip, F.col("x1")).otherwise(F.col("x2")).alias("xb"),
        F.when(flip, F.col("y1")).otherwise(F.col("y2")).alias("yb"),
    ).where((F.col("xt") != F.col("xb")) | (F.col("yt") != F.col("yb")))
    first, last = [F.floor(F.col(y) / F.lit(band)).cast("int") for y in ("yt", "yb")]
    slot = F.pmod(F.col("part.low"), F.lit(SLOTS)).cast("int")
    pieces = ordered.withColumn("band", F.explode(F.sequence(first, last))).withColumn("slot", slot)
    pieces = spread(pieces, [*LOC, "slot", "band"], rows, ROWS_PER_TASK)
    return pieces.groupBy(*PART, "xt", "yt", "xb", "yb").agg(F.count(F.lit(1)).alias("n"))


def _rows(first: Column, last: Column, height: int, band: int) -> Column:
    top = F.col("band") * F.lit(band)
    first = F.greatest(first, top, F.lit(0)).cast("int")
    last = F.least(last, top + F.lit(band - 1), F.lit(height - 1)).cast("int")
    return F.explode(F.when(first <= last, F.sequence(first, last)))


def _clip(col: Column, width: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(width), col)).cast("int")


def _x_at(y: Column) -> Column:
    slope = (F.col("xb") - F.col("xt")) / (F.col("yb") - F.col("yt"))
    return F.col("xt") + (y - F.col("yt")) * slope


def _center_column(width: int) -> Column:
    """First pixel whose centre is right of the edge in row r; a centre on the edge counts."""
    half = F.lit(0.5)
    return _clip(F.ceil(_x_at(F.col("r") + half) - half), width)


def _inside(pieces: DataFrame, width: int, height: int, band: int) -> DataFrame:
    """Spans of pixel centres inside a part: from each odd crossing of its edges to the next. An
    edge that the part runs along an even number of times is no border."""
    first, last = F.ceil(F.col("yt") - F.lit(0.5)), F.ceil(F.col("yb") - F.lit(0.5)) - 1
    rows = pieces.where((F.col("yt") < F.col("yb")) & (F.col("n") % 2 == 1)).withColumn("r", _rows(first, last, height, band))
    crossed = rows.select(*PART, "r", _center_column(width).alias("c"))
    crossed = crossed.groupBy(*PART, "r", "c").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    along = Window.partitionBy(*PART, "r").orderBy("c")
    spans = crossed.select(
        *PART, "r", F.col("c").alias("c0"), F.lead("c").over(along).alias("c1"), F.row_number().over(along).alias("nth")
    )
    return spans.where("nth % 2 = 1").select(*LOC, "slot", "band", "r", "c0", F.coalesce("c1", F.lit(width)).alias("c1"))


def _touched(pieces: DataFrame, width: int, height: int, band: int) -> DataFrame:
    """Spans of the pixels an edge passes through, also one that is run along twice: a spike, or a
    part without any area, touches what it passes."""
    top = F.floor("yt")
    rows = pieces.withColumn("r", _rows(top, F.greatest(top, F.ceil("yb") - 1), height, band))
    flat = F.col("yt") == F.col("yb")
    xa = F.when(flat, F.col("xt")).otherwise(_x_at(F.greatest(F.col("yt"), F.col("r"))))
    xb = F.when(flat, F.col("xb")).otherwise(_x_at(F.least(F.col("yb"), F.col("r") + 1)))
    rows = rows.select(*LOC, "slot", "band", "r", F.least(xa, xb).alias("lo"), F.greatest(xa, xb).alias("hi"))
    start = F.floor("lo")
    end = F.greatest(start + 1, F.ceil("hi"))
    return rows.select(*LOC, "slot", "band", "r", _clip(start, width).alias("c0"), _clip(end, width).alias("c1"))


def _spans(edges: DataFrame, width: int, height: int, rule: str, band: int = BAND) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    n = edge_rows(edges, height)
    pieces = spread_edges(edges, band, n)
    spans = _inside(pieces, width, height, band)
    if rule == "all_touched":
        spans = spans.unionByName(_touched(pieces, width, height, band))
    return disjoint_spans(spans, width, n)


def disjoint_spans(spans: DataFrame, width: int, rows: int = 0) -> DataFrame:
    """The union of spans of a location, row by row, by a running total of their steps. Spans lie
    where their slot and band were sent; `rows` is the work that gives the number of tasks."""
    ends = F.array(
        F.struct(F.col("c0").alias("c"), F.lit(1).cast("bigint").alias("weight")),
        F.struct(F.col("c1").alias("c"), F.lit(-1).cast("bigint").alias("weight")),
    )
    steps = spans.where("c0 < c1").select(*LOC, "slot", "band", "r", F.inline(ends))
    # Sums per slot run before the shuffle, so a million parts in one place cost a row per step and slot.
    steps = steps.groupBy(*LOC, "slot", "band", "r", "c").agg(F.sum("weight").alias("weight")).where("weight <> 0")
    steps = spread(steps, [*LOC, "band", "r", "c"], rows, ROWS_PER_TASK)
    steps = steps.groupBy(*LOC, "band", "r", "c").agg(F.sum("weight").alias("weight")).where("weight <> 0")
    # one exchange for the running totals and for whoever groups by band afterwards
    steps = spread(steps, [*LOC, "band"], rows, ROWS_PER_TASK)
    along = Window.partitionBy(*LOC, "band", "r").orderBy("c")
    depth = steps.select(
        *LOC,
        "band",
        "r",
        F.col("c").alias("c0"),
        F.lead("c").over(along).alias("c1"),
        F.sum("weight").over(along).alias("depth"),
    )
    return depth.where(F.col("depth") > 0).select(*LOC, "band", "r", "c0", F.coalesce("c1", F.lit(width)).alias("c1"))


def _banded_spans(locations: DataFrame, grid: Grid, rule: str) -> DataFrame:
    """Covered spans with `band`, the segment row they lie in."""
    edges = polygon_edges(locations, grid.x_to_px, grid.y_to_px)
    return _spans(edges, grid.width, grid.height, rule, grid.block)


def coverage_spans(locations: DataFrame, grid: Grid, rule: str = "center") -> DataFrame:
    """Disjoint covered spans [c0, c1) per location and global pixel row r."""
    return _banded_spans(locations, grid, rule).drop("band")


def coverage_runs(locations: DataFrame, grid: Grid, rule: str = "center") -> DataFrame:
    """Spans cut at segment borders: key, row r and [c0, c1) inside the segment."""
    size = F.lit(grid.block)
    spans = _banded_spans(locations, grid, rule)
    first, last = F.floor(F.col("c0") / size).cast("int"), F.floor((F.col("c1") - 1) / size).cast("int")
    cut = spans.withColumn("key_col", F.explode(F.sequence(first, last)))
    left = F.col("key_col") * size
    return cut.select(
        *LOC,
        "key_col",
        F.col("band").alias("key_row"),
        (F.col("r") % size).alias("r"),
        (F.greatest(F.col("c0"), left) - left).alias("c0"),
        (F.least(F.col("c1"), left + size) - left).alias("c1"),
    )


def coverage_cells(locations: DataFrame, grid: Grid, rule: str = "center") -> DataFrame:
    """One row per location and segment with `runs`, the sorted [i0, i1) ranges of covered
    cells in row-major order, none longer than a block row, and `n_pixels`. A group is
    bounded by the cells of a block."""
    offset = F.col("r") * F.lit(grid.block)
    run = F.struct((offset + F.col("c0")).alias("i0"), (offset + F.col("c1")).alias("i1"))
    return (
        coverage_runs(locations, grid, rule)
        .groupBy(*LOC, *KEY)
        .agg(F.sort_array(F.collect_list(run)).alias("runs"), F.sum(F.col("c1") - F.col("c0")).alias("n_pixels"))
    )


def coverage_pixels(locations: DataFrame, grid: Grid, rule: str = "center") -> DataFrame:
    """One row per covered pixel: key and row r, column c inside the segment."""
    runs = coverage_runs(locations, grid, rule)
    return runs.select(*LOC, *KEY, "r", F.explode(F.sequence(F.col("c0"), F.col("c1") - F.lit(1))).alias("c"))


def covered_pixels(locations: DataFrame, grid: Grid, by: list[str], rule: str = "center") -> DataFrame:
    """Number of covered pixels per group, from the spans alone."""
    spans = coverage_spans(locations, grid, rule)
    return spans.groupBy(*by).agg(F.sum((F.col("c1") - F.col("c0")).cast("bigint")).alias("n"))


def segment_cover(locations: DataFrame, grid: Grid, unit: str = "segment", rule: str = "all_touched") -> DataFrame:
    """Segment (or file) keys a location touches."""
    size = {"segment": grid.block, "file": grid.file_px}[unit]
    edges = polygon_edges(
        locations,
        lambda lon: grid.x_to_px(lon) / F.lit(float(size)),
        lambda lat: grid.y_to_px(lat) / F.lit(float(size)),
    )
    spans = _spans(edges, grid.width // size, grid.height // size, rule)
    keys = F.explode(F.sequence(F.col("c0"), F.col("c1") - F.lit(1)))
    return spans.select(*LOC, keys.alias("key_col"), F.col("r").alias("key_row"))


def dense_mask(runs: Column, cells: int) -> Column:
    """Runs to a full mask tile: 1 inside, NULL outside."""
    ends = F.transform(runs, lambda run: run["i1"])
    nothing = F.lit(None).cast("int")
    steps = F.zip_with(
        runs,
        F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1)),
        lambda run, before: F.concat(
            F.array_repeat(nothing, run["i0"] - before), F.array_repeat(F.lit(1), run["i1"] - run["i0"])
        ),
    )
    tail = F.array_repeat(nothing, F.lit(cells) - F.element_at(ends, -1))
    return F.concat(F.flatten(steps), tail)


def cell_map(cells: DataFrame, grid: Grid, value: str = "runs", max_entries: int = MAP_ENTRIES) -> DataFrame:
    """Group coverage by list and segment into `geom_cells`: location_id -> runs or mask.

    A map holds locations of one range of `max_entries` ids, numbered by `part`. The ids alone
    decide on that, so a map's shape does not depend on what else lies in the segment, and no map
    grows with the data. `explode_cell_map` reads all parts the same way. The coverage is written
    first, and its runs say how many tasks gather it.
    """
    if value not in ("runs", "mask"):
        raise ValueError("value must be 'runs' or 'mask'")
    part = F.floor(F.col("location_id") / F.lit(max_entries)).cast("bigint")
    cells = stage(cells.select("list_id", *KEY, part.alias("part"), "location_id", "runs"))
    by = ["list_id", *KEY, "part"]
    n = cells.agg(F.sum(F.size("runs").cast("bigint"))).first()[0] or 0
    cells = sent(cells, by, more_tasks(cells.sparkSession, n, RUNS_PER_TASK))
    entries = F.collect_list(F.struct("location_id", "runs"))
    maps = cells.groupBy(*by).agg(F.map_from_entries(entries).alias("geom_cells"))
    if value == "mask":
        # runs go through the shuffle; masks, a thousand times as large, are made after it
        masks = F.transform_values("geom_cells", lambda _, runs: dense_mask(runs, grid.cells))
        maps = maps.withColumn("geom_cells", masks)
    return maps


def explode_cell_map(maps: DataFrame, value: str = "runs") -> DataFrame:
    """Back from a cell map to one row per location and segment."""
    return maps.select("list_id", *KEY, F.explode("geom_cells").alias("location_id", value))
