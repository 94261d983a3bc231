"""Area per class of a coded layer and location.

Codes run to 50,011 and a location holds few of them, so there is no slot per code: counts are rows
of (location, code), and a map is made only at the end, with as many entries as the location has codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.functions.grid import Grid
from zonal.operators.coverage import LOC
from zonal.operators.layers import ROWS_PER_TASK, covered_values
from zonal.operators.legends import area_by_class
from zonal.plans.jobs import with_pixel_area


def class_areas(
    locations: DataFrame, tiles: DataFrame, layer: str, grid: Grid = Grid(), rule: str = "center", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Hectares of each code a location covers: list_id, location_id, code, area. Pixels are counted
    per segment row, and the area of one scales the count."""
    pixels = covered_values(locations, tiles, [layer], grid, rule, required=layer, rows_per_task=rows_per_task)
    codes = pixels.where(F.col(layer).isNotNull()).select(*LOC, "key_row", F.col(layer).alias("code"))
    counts = codes.groupBy(*LOC, "key_row", "code").agg(F.count(F.lit(1)).alias("n"))
    scaled = with_pixel_area(counts, grid).select(*LOC, "code", (F.col("n") * F.col("area")).alias("area"))
    return scaled.groupBy(*LOC, "code").agg(F.sum("area").alias("area"))


def class_maps(areas: DataFrame) -> DataFrame:
    """Class areas as one MAP<INT, DOUBLE> per location, of the codes it has."""
    entries = F.map_from_entries(F.collect_list(F.struct("code", "area")))
    return areas.groupBy(*LOC).agg(entries.alias("areas"))


def add_class_maps(maps: DataFrame, by: list[str]) -> DataFrame:
    """The sum, code by code, of the maps of each group."""
    entries = maps.select(*by, F.explode("areas").alias("code", "area"))
    summed = entries.groupBy(*by, "code").agg(F.sum("area").alias("area"))
    return summed.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("code", "area"))).alias("areas"))


def labelled_areas(areas: DataFrame, legend: str, variant: str | None = None) -> DataFrame:
    """Class areas with the labels of a legend, summed where codes share one."""
    return area_by_class(areas, "code", legend, variant, LOC)
