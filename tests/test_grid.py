from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zonal import Grid
from zonal.functions.geodesy import pixel_area_ha
from zonal.functions.grid import extent_ring, grid_id_to_bounds, point_grid_id


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "x, y, expected", [(110.5, -0.5, "00N_110E"), (-0.5, 10.0, "10N_010W"), (0.0, 0.0, "00N_000E"), (-180.0, -80.5, "80S_180W")]
)
def test_point_grid_id(spark, x, y, expected):
    assert one(spark, point_grid_id(F.lit(x), F.lit(y), 10)) == expected


@pytest.mark.parametrize(
    "grid_id, expected",
    [
        ("10N_010E", "010E_00N_020E_10N"),
        ("00N_110E", "110E_10S_120E_00N"),
        ("10S_010W", "010W_20S_000E_10S"),
    ],
)
def test_grid_id_to_bounds(spark, grid_id, expected):
    assert one(spark, grid_id_to_bounds(F.lit(grid_id))) == expected


@pytest.mark.parametrize(
    "key_row, lat, expected",
    [
        (899, 0.05, 0.07693167184379367),
        (900, -0.05, 0.0769316721288893),
        (1134, -23.45, 0.07072768305013022),
    ],
)
def test_pixel_area(spark, key_row, lat, expected):
    grid = Grid()
    assert one(spark, grid.key_lat(F.lit(key_row))) == pytest.approx(lat, abs=1e-12)
    assert one(spark, pixel_area_ha(grid, F.lit(key_row))) == pytest.approx(expected, rel=1e-9)


def test_sizes():
    grid = Grid()
    assert (grid.cols, grid.rows, grid.file_px, grid.cells, grid.file_count) == (3600, 1800, 40000, 160000, 648)
    with pytest.raises(ValueError):
        Grid(px_per_deg=4000, file_deg=10, block=300)


def test_key_and_extent_round_trip(spark):
    grid = Grid()
    keys = spark.range(0, 1800, 7).select(F.col("id").cast("int").alias("row"), (F.col("id") * 2).cast("int").alias("col"))
    extents = keys.withColumn("e", grid.key_extent(F.col("col"), F.col("row")))
    back = extents.withColumn("k", grid.extent_key(F.col("e")))
    assert back.where("k.col <> col or k.row <> row").count() == 0
    ring = extents.select(F.size(extent_ring(F.col("e"))).alias("n"), extent_ring(F.col("e")).alias("r")).first()
    assert ring["n"] == 5 and ring["r"][0] == ring["r"][4]


def test_world_edge_points_are_clamped(spark):
    key = one(spark, Grid().point_key(F.lit(180.0), F.lit(-90.0)))
    assert (key["col"], key["row"]) == (3599, 1799)


def test_tile_uri(spark):
    grid = Grid()
    template = F.lit("s3://t/{grid_size}/{row_count}/x/{tile_id}.tif")
    uri = grid.fill_template(template, grid.tile_id(F.lit(29), F.lit(9)))
    assert one(spark, uri) == "s3://t/10/40000/x/00N_110E.tif"
    assert one(spark, grid.tile_id(F.lit(17), F.lit(8))) == "10N_010W"
    assert one(spark, grid.tile_id(F.lit(0), F.lit(17))) == "80S_180W"
    assert one(spark, grid.file_of_key(F.lit(2999))) == 29


def test_points_outside_the_world_have_no_key(spark):
    points = [(180.0, -90.0), (-180.0, 90.0), (-500.0, 0.0), (0.0, 95.0), (float("nan"), 0.0)]
    df = spark.createDataFrame(points, "x double, y double")
    got = [tuple(r["k"]) for r in df.select(Grid().point_key(F.col("x"), F.col("y")).alias("k")).collect()]
    assert got == [(3599, 1799), (0, 0), (None, 900), (1800, None), (None, 900)]
