"""Coverage on two levels: whole segments as one flag, runs of cells only along the border.

Within one row of segments (a band) the edges of a part touch some segments; side by side these
form stretches. Left and right of a stretch nothing changes from pixel row to pixel row, so whether
the part is inside there is one bit, counted along a single pixel row. Where it is inside, all
segments up to the next stretch are covered whole. Pixel rows are only looked at inside stretches:
a stretch that begins inside has a crossing at its left end in every row. The work grows with the
length of the border and no longer with the area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonal.functions.grid import Grid
from zonal.operators.coverage import (
    LOC, PART, ROWS_PER_TASK, RULES, _clip, _touched, _x_at, disjoint_spans, edge_rows, polygon_edges, spread_edges,
)
from zonal.operators.staging import spread, stage

STRETCH = (*PART, "stretch")


def _segment_of(x: Column, grid: Grid) -> Column:
    """Segment column of a pixel coordinate; -1 and `cols` stand for all that lies outside the world."""
    return F.greatest(F.lit(-1), F.least(F.lit(grid.cols), F.floor(x / F.lit(grid.block)))).cast("int")


def _band_rows(grid: Grid) -> tuple[Column, Column]:
    return F.col("band") * F.lit(grid.block), F.least((F.col("band") + 1) * F.lit(grid.block), F.lit(grid.height))


def _events(pieces: DataFrame, grid: Grid) -> DataFrame:
    """Touched segments (kind 0) and crossings of pixel rows (kind 1: r, c), each with its stretch,
    the stretch's first and last segment, whether the part is `inside` before and `beyond` it, and
    the `following` touched segment."""
    top, bottom = _band_rows(grid)
    flat = F.col("yt") == F.col("yb")
    ends = [
        F.when(flat, F.col(x)).otherwise(_x_at(y))
        for x, y in (("xt", F.greatest(F.col("yt"), top)), ("xb", F.least(F.col("yb"), bottom)))
    ]
    touched = F.sequence(_segment_of(F.least(*ends), grid), _segment_of(F.greatest(*ends), grid))
    nothing = F.lit(None).cast("int")
    segments = pieces.select(*PART, F.explode(touched).alias("seg")).distinct()
    segments = segments.select(*PART, "seg", F.lit(0).alias("kind"), nothing.alias("r"), nothing.alias("c"))

    half = F.lit(0.5)
    first = F.greatest(F.ceil(F.col("yt") - half), top).cast("int")
    last = F.least(F.ceil(F.col("yb") - half), bottom).cast("int") - 1
    borders = pieces.where(~flat & (F.col("n") % 2 == 1))
    rows = borders.withColumn("r", F.explode(F.when(first <= last, F.sequence(first, last))))
    x = _x_at(F.col("r") + half)
    crossings = rows.select(*PART, _segment_of(x, grid).alias("seg"), F.lit(1).alias("kind"), "r", _clip(F.ceil(x - half), grid.width).alias("c"))

    along = Window.partitionBy(*PART).orderBy("seg", "kind")
    before = F.lag("seg").over(along)
    begins = ((F.col("kind") == 0) & (before.isNull() | (F.col("seg") - before > 1))).cast("int")
    events = segments.unionByName(crossings).withColumn("begins", begins)
    events = events.withColumn("stretch", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*STRETCH)
    earlier = Window.partitionBy(*PART).orderBy("stretch").rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*PART).orderBy("stretch").rangeBetween(1, 1)
    crossed = F.when((F.col("kind") == 1) & (F.col("r") == top), 1).otherwise(0)
    odd = F.coalesce(F.sum("crossed").over(earlier), F.lit(0))
    return (
        events.withColumn("crossed", crossed)
        .withColumn("first", F.min("seg").over(whole))
        .withColumn("last", F.max("seg").over(whole))
        .withColumn("inside", odd % 2 == 1)
        .withColumn("beyond", (odd + F.sum("crossed").over(whole)) % 2 == 1)
        .withColumn("following", F.min("seg").over(later))
    )


def _border_spans(events: DataFrame, grid: Grid, n: int) -> DataFrame:
    """Covered spans of pixel rows inside stretches, `n` rows in all."""
    top, bottom = _band_rows(grid)
    begun = events.where((F.col("kind") == 0) & (F.col("seg") == F.col("first")) & F.col("inside"))
    left = _clip(F.col("first") * F.lit(grid.block), grid.width)
    begun = begun.select(*STRETCH, "last", F.explode(F.sequence(top, bottom - 1)).alias("r"), left.alias("c"))
    crossed = events.where("kind = 1").select(*STRETCH, "last", "r", "c")
    turns = spread(begun.unionByName(crossed), [*LOC, "slot", "band"], n, ROWS_PER_TASK)
    turns = turns.groupBy(*STRETCH, "last", "r", "c").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    along = Window.partitionBy(*STRETCH, "last", "r").orderBy("c")
    right = _clip((F.col("last") + 1) * F.lit(grid.block), grid.width)
    spans = turns.select(
        *LOC, "slot", "band", "r", F.col("c").alias("c0"), F.least(F.coalesce(F.lead("c").over(along), right), right).alias("c1"),
        F.row_number().over(along).alias("nth"),
    )
    return spans.where((F.col("nth") % 2 == 1) & (F.col("c0") < F.col("c1"))).drop("nth")


def _whole_segments(events: DataFrame, grid: Grid, n: int) -> DataFrame:
    """Segments between stretches that a part covers whole, sent to where the spans of their band are."""
    ends = events.where((F.col("kind") == 0) & (F.col("seg") == F.col("last")) & F.col("beyond"))
    first = F.greatest(F.col("last") + 1, F.lit(0))
    last = F.least(F.coalesce("following", F.lit(grid.cols)), F.lit(grid.cols)) - 1
    inner = spread(ends.select(*LOC, "band", first.alias("first"), last.alias("last")), [*LOC, "band"], n, ROWS_PER_TASK)
    inside = F.when(F.col("first") <= F.col("last"), F.sequence(F.col("first"), F.col("last")))
    return inner.select(*LOC, "band", F.explode(inside).alias("key_col")).distinct()


def two_level_cells(locations: DataFrame, grid: Grid, rule: str = "center") -> DataFrame:
    """One row per location and segment it covers: `whole`, and for those that are not, `runs` as in
    `coverage_cells`; `n_pixels` for all. A segment that one part covers whole is whole, whatever
    other parts add there."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    edges = polygon_edges(locations, grid.x_to_px, grid.y_to_px)
    n = edge_rows(edges, grid.height)
    pieces = spread_edges(edges, grid.block, n).where(F.col("band").between(0, grid.rows - 1))
    events = stage(_events(pieces, grid))  # read three times
    spans = _border_spans(events, grid, n)
    if rule == "all_touched":
        spans = spans.unionByName(_touched(pieces, grid.width, grid.height, grid.block))
    spans = disjoint_spans(spans, grid.width, n)
    size = F.lit(grid.block)
    first, last = F.floor(F.col("c0") / size).cast("int"), F.floor((F.col("c1") - 1) / size).cast("int")
    cut = spans.withColumn("key_col", F.explode(F.sequence(first, last)))
    offset = (F.col("r") % size) * size - F.col("key_col") * size
    i0 = offset + F.greatest(F.col("c0"), F.col("key_col") * size)
    i1 = offset + F.least(F.col("c1"), (F.col("key_col") + 1) * size)
    run = F.struct(i0.cast("int").alias("i0"), i1.cast("int").alias("i1"))
    runs = cut.select(*LOC, "band", "key_col", run.alias("run"), F.lit(False).alias("whole"))
    inner = _whole_segments(events, grid, n)
    flags = inner.select(*LOC, "band", "key_col", F.lit(None).cast(runs.schema["run"].dataType).alias("run"), F.lit(True).alias("whole"))
    grouped = runs.unionByName(flags).groupBy(*LOC, "band", "key_col").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list("run")).alias("runs"), F.sum(F.col("run.i1") - F.col("run.i0")).alias("n")
    )
    return grouped.select(
        *LOC,
        "key_col",
        F.col("band").alias("key_row"),
        "whole",
        F.when(~F.col("whole"), F.col("runs")).alias("runs"),
        F.when(F.col("whole"), F.lit(grid.cells)).otherwise(F.col("n")).cast("bigint").alias("n_pixels"),
    )
