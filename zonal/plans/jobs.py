"""The two end-to-end jobs. Same answer, different amount of work per pixel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.functions.geodesy import pixel_area_ha
from zonal.functions.grid import Grid
from zonal.operators.aggregates import (
    BUCKETS, dense_maps, loss_year_agg, sums_by_bucket, sums_written, year_bucket, zonal_histogram,
)
from zonal.operators.coverage import LOC
from zonal.operators.layers import ROWS_PER_TASK, covered_values
from zonal.plans.analyses import Analysis, Layers, contributing, needed_layers, standard_analyses
from zonal.sources.locations import read_geojson
from zonal.sources.results import write_results
from zonal.sources.tiles import read_tiles

BY = list(LOC)


def with_pixel_area(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Add `area` (ha) to pixel rows. The trigonometry runs once per segment row of the
    grid, not once per pixel; the table has exactly `grid.rows` rows."""
    rows = pixels.sparkSession.range(grid.rows).select(F.col("id").cast("int").alias("key_row"))
    areas = rows.select("key_row", pixel_area_ha(grid, F.col("key_row")).alias("area"))
    # one small row per segment row of the grid: bounded whatever the data
    return pixels.join(F.broadcast(areas), "key_row")


def pixelwise_totals(
    pixels: DataFrame, analyses: list[Analysis], loss: str, by: list[str] = BY, strict: bool = False
) -> DataFrame:
    """Dense yearly maps from pixel rows that carry `area` and one column per layer."""
    areas = {a.name: a.content(F.col("area")) for a in analyses}
    return loss_year_agg(pixels, by, F.col(loss), areas, strict)


def scalar_totals(pixels: DataFrame, analyses: list[Analysis], by: list[str] = BY) -> DataFrame:
    """One area per group for analyses that are not split by year."""
    named = pixels.select(*by, *[a.content(F.col("area")).alias(a.name) for a in analyses])
    return named.groupBy(*by).agg(*[F.coalesce(F.sum(a.name), F.lit(0.0)).alias(a.name) for a in analyses])


def required_layer(analyses: list[Analysis], loss: str) -> str | None:
    """The loss layer where nothing can be found without it."""
    return loss if all(a.yearly for a in analyses) else None


def _check_areas_of_interest(locations: DataFrame) -> None:
    """Fail if some list has no area-of-interest row (location_id = -1)."""
    per_list = locations.groupBy("list_id").agg(F.max((F.col("location_id") == -1).cast("int")).alias("has"))
    if per_list.where("has = 0").limit(1).count():
        raise ValueError("every list needs an area-of-interest row with location_id = -1")


def loss_by_year_pixelwise(
    locations: DataFrame,
    tiles: DataFrame,
    grid: Grid = Grid(),
    layers: Layers = Layers(),
    analyses: list[Analysis] | None = None,
    rule: str = "center",
    strict: bool = False,
    require_aoi: bool = False,
) -> DataFrame:
    """Every covered pixel becomes a row, areas are summed. One column per analysis: the map of
    all years for a yearly one, the area for the others. The coverage is written to the
    staging folder when this is called, not when the result is read."""
    analyses = standard_analyses(layers) if analyses is None else analyses
    if require_aoi:
        _check_areas_of_interest(locations)
    pixels = covered_values(
        locations,
        tiles,
        needed_layers(analyses, layers.loss),
        grid,
        rule,
        required=required_layer(analyses, layers.loss),
        carry={"area": pixel_area_ha(grid, F.col("key_row"))},
    )
    pixels = pixels.where(contributing(analyses, layers.loss, strict))
    areas = {a.name: a.content(F.col("area")) for a in analyses}
    groups = locations.count() * BUCKETS
    long = sums_written(sums_by_bucket(pixels, BY, year_bucket(F.col(layers.loss), strict), areas), groups)
    return _every_location(long, locations, analyses, groups)


def loss_by_year_histogram(
    locations: DataFrame,
    tiles: DataFrame,
    grid: Grid = Grid(),
    layers: Layers = Layers(),
    analyses: list[Analysis] | None = None,
    rule: str = "center",
    strict: bool = False,
    require_aoi: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The same from pixel counts: counts are exact integers, and the area of a segment row
    scales them once they are down to a few rows per location."""
    analyses = standard_analyses(layers) if analyses is None else analyses
    if require_aoi:
        _check_areas_of_interest(locations)
    pixels = covered_values(
        locations,
        tiles,
        needed_layers(analyses, layers.loss),
        grid,
        rule,
        required=required_layer(analyses, layers.loss),
        rows_per_task=rows_per_task,
    )
    return totals_of_counts(pixel_counts(pixels, analyses, layers.loss, strict), locations, analyses, grid)


def pixel_counts(pixels: DataFrame, analyses: list[Analysis], loss: str, strict: bool = False) -> DataFrame:
    """Pixel rows to counts per location, segment row, year slot and analysis."""
    found = pixels.where(contributing(analyses, loss, strict))
    return zonal_histogram(found, [*BY, "key_row"], F.col(loss), {a.name: a.criterion() for a in analyses}, strict)


def totals_of_counts(counts: DataFrame, locations: DataFrame, analyses: list[Analysis], grid: Grid) -> DataFrame:
    """Counts per location, segment row and year slot to the maps and areas of every location."""
    names = [a.name for a in analyses]
    groups = locations.count() * BUCKETS
    # as many groups for every row of segments that a location lies in: most lie in one or two
    counts = sums_written(counts, groups)
    scaled = with_pixel_area(counts, grid).select(*BY, "bucket", *[(F.col(n) * F.col("area")).alias(n) for n in names])
    long = sums_written(scaled.groupBy(*BY, "bucket").agg(*[F.sum(n).alias(n) for n in names]), groups)
    return _every_location(long, locations, analyses, groups)


def _every_location(long: DataFrame, locations: DataFrame, analyses: list[Analysis], groups: int) -> DataFrame:
    """Maps and areas with a row for every input location, all zeros where nothing was covered. There
    are at most `groups` sums."""
    names = [a.name for a in analyses]
    nothing = locations.select(
        *BY, F.lit(None).cast("int").alias("bucket"), *[F.lit(None).cast("double").alias(n) for n in names]
    )
    yearly, scalar = [a.name for a in analyses if a.yearly], [a.name for a in analyses if not a.yearly]
    return dense_maps(long.unionByName(nothing), BY, yearly, scalar, groups).select(*BY, *names)


def run_report(
    spark: SparkSession,
    location_paths: str | list[str],
    tiles_path: str,
    out_path: str,
    method: str = "histogram",
    properties: str = "list_id string, location_id bigint",
    one_feature_per_line: bool = False,
    files: int | None = None,
    **options,
) -> None:
    """The whole report: GeoJSON locations and a tile table in, JSON results out."""
    jobs = {"histogram": loss_by_year_histogram, "pixelwise": loss_by_year_pixelwise}
    locations = read_geojson(spark, location_paths, properties, one_feature_per_line)
    totals = jobs[method](locations, read_tiles(spark, tiles_path), **options)
    write_results(totals, out_path, files=files)


__all__ = [
    "BUCKETS",
    "loss_by_year_histogram",
    "loss_by_year_pixelwise",
    "pixelwise_totals",
    "run_report",
    "scalar_totals",
    "with_pixel_area",
]
