from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.shapes import TINY, frame
from zonal import Grid
from zonal.functions import tile_algebra as ta
from zonal.operators import layers as lay
from zonal.sources.tiles import read_tiles, tile_summary, write_tiles

TWO = Grid(px_per_deg=2, file_deg=10, block=2)


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame([([1, None, 3, 0], [2, 5, None, 7])], "a array<int>, b array<int>")


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_algebra(pair):
    a, b = F.col("a"), F.col("b")
    assert value(pair, ta.local_multiply(a, b)) == [2, None, None, 0]
    assert value(pair, ta.local_greater(a, 1)) == [0, None, 1, 0]
    assert value(pair, ta.mask(a, b)) == [1, None, None, 0]
    assert value(pair, ta.mask_by_value(b, a, 0)) == [2, 5, None, None]
    assert value(pair, ta.tile_max(a)) == 3
    assert value(pair, ta.criterion_tile(a, b, 1)) == [1, None, None, 0]


def test_nan_is_not_a_loss_year(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (19.0,), (0.0,)], "v double")
    assert [r["y"] for r in df.select(ta.calendar_year(F.col("v")).alias("y")).collect()] == [None, None, 2019, 2000]
    assert df.where(ta.clean_nan(F.col("v")) > 0).count() == 1


def tiles(spark):
    rows = [(0, 0, "a", [1, 2, 3, None]), (1, 0, "a", [5, 6, 7, 8]), (0, 0, "b", [9, 9, 9, 9])]
    return spark.createDataFrame(rows, "key_col int, key_row int, layer string, cells array<int>")


def test_join_layers_keeps_keys_without_tiles(spark):
    keys = spark.createDataFrame([(0, 0), (1, 0), (5, 5)], "key_col int, key_row int")
    got = {(r["key_col"], r["key_row"]): (r["a"], r["b"]) for r in lay.join_layers(keys, tiles(spark), ["a", "b"]).collect()}
    assert got == {(0, 0): ([1, 2, 3, None], [9] * 4), (1, 0): ([5, 6, 7, 8], None), (5, 5): (None, None)}


def test_explode_tiles_gives_null_cells_for_a_missing_tile(spark):
    keys = spark.createDataFrame([(0, 0), (1, 0), (5, 5)], "key_col int, key_row int")
    cells = lay.explode_tiles(lay.join_layers(keys, tiles(spark), ["a", "b"]), ["a", "b"], TWO)
    got = sorted((r["key_col"], r["cell"], r["a"], r["b"]) for r in cells.collect() if r["key_col"] == 1)
    assert got == [(1, i, 5 + i, None) for i in range(4)]
    assert cells.count() == 12 and cells.where("a is null and b is null").count() == 4


def test_tile_table_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "tiles")
    write_tiles(tiles(spark), path, TWO)
    back = read_tiles(spark, path)
    assert sorted(map(tuple, back.select("key_col", "key_row", "layer", "cells").collect())) == sorted(
        map(tuple, tiles(spark).collect())
    )
    plan = read_tiles(spark, path, ["a"]).select("key_col")._jdf.queryExecution().executedPlan().toString()
    assert "(layer#" in plan.split("PartitionFilters")[1] and "cells" not in plan.split("ReadSchema")[1]
    assert {(r["layer"], r["key_col"]): r["n_valid"] for r in tile_summary(back).collect()} == {
        ("a", 0): 3, ("a", 1): 4, ("b", 0): 4
    }


def test_area_tiles(spark):
    square = [[(2.2, 2.2), (7.8, 2.2), (7.8, 7.8), (2.2, 7.8)]]
    df = frame(spark, [(1, -1, square), (1, 4, [[(500.2, 200.1), (510.0, 200.1), (505.0, 208.0)]])])
    kept = lay.area_tiles(tiles(spark), df, TINY).collect()
    assert {(r["key_col"], r["layer"]) for r in kept} == {(0, "a"), (0, "b")}


def test_locations_with_tiles_and_spatial_join(spark):
    square = [[(2.2, 2.2), (17.8, 2.2), (17.8, 7.8), (2.2, 7.8)]]
    df = frame(spark, [(1, 1, square)])
    from zonal import coverage_cells

    held = lay.locations_with_tiles(coverage_cells(df, TINY), tiles(spark), "b", TINY).collect()
    assert [(r["key_col"], r["n_pixels"]) for r in held] == [(0, 48)]
    pairs = lay.spatial_join(df, tiles(spark), TINY).collect()
    assert sorted((r["key_col"], r["layer"]) for r in pairs) == [(0, "a"), (0, "b"), (1, "a")]
