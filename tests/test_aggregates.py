from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zonal import Grid
from zonal.operators import aggregates as agg

TWO = Grid(px_per_deg=2, file_deg=10, block=2)


def test_loss_year_agg_is_dense_and_skips_nulls(spark):
    rows = [(1, 3, 2.5), (1, 3, 1.5), (1, 0, 4.0), (1, None, 9.0), (1, 5, None), (2, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, year int, area double")
    got = {r["id"]: r["area"] for r in agg.loss_year_agg(df, ["id"], F.col("year"), {"area": F.col("area")}).collect()}
    assert set(got) == {1, 2} and all(sorted(m) == list(range(32)) for m in got.values())
    assert {k: v for k, v in got[1].items() if v} == {3: 4.0, 0: 4.0}
    assert not any(got[2].values())


def test_codes_outside_the_slots(spark):
    df = spark.createDataFrame([(1, 3, 2.0), (1, 32, 5.0), (1, -1, 7.0)], "id int, year int, area double")
    area = {"area": F.col("area")}
    got = agg.loss_year_agg(df, ["id"], F.col("year"), area).first()["area"]
    assert sum(got.values()) == 2.0
    with pytest.raises(Exception, match="outside 0..31"):
        agg.loss_year_agg(df, ["id"], F.col("year"), area, strict=True).collect()


def test_conditional_sums_per_year(spark):
    rows = [(7, 2003, 90, 40), (7, 2003, 95, 3), (7, 2003, 97, 5), (7, 2009, 30, 6), (7, 2009, 29, 8), (7, 2015, None, 2)]
    df = spark.createDataFrame(rows, "id int, loss_year int, tcd int, area int")
    measures = {"gt90": F.when(F.col("tcd") > 90, F.col("area")), "lt30": F.when(F.col("tcd") < 30, F.col("area"))}
    got = {r["bucket"]: (r["gt90"], r["lt30"]) for r in agg.sums_by_bucket(df, ["id"], F.col("loss_year"), measures).collect()}
    assert got == {2003: (8, None), 2009: (None, 8), 2015: (None, None)}


def test_histogram_agg_and_scale(spark):
    rows = [(1, [1.0, 2.0]), (1, [0.5] * 32), (2, None)]
    df = spark.createDataFrame(rows, "id int, h array<double>").withColumn("h", agg.scale_histogram(F.col("h"), F.lit(2.0)))
    got = {r["id"]: r["h"] for r in agg.histogram_agg(df, ["id"], ["h"]).collect()}
    assert got[1] == {0: 3.0, 1: 5.0, **{i: 1.0 for i in range(2, 32)}}
    assert got[2] == {i: 0.0 for i in range(32)}


def test_tile_histograms(spark):
    df = spark.createDataFrame([(1, [3, 3, None, 40], [1, 0, 1, 1]), (2, None, [1, 1, 1, 1])], "id int, v array<int>, w array<int>")
    counts = {r["id"]: r["h"] for r in agg.tile_histograms(df, ["id"], "v", None, TWO, "h").collect()}
    sums = {r["id"]: r["h"] for r in agg.tile_histograms(df, ["id"], "v", "w", TWO, "h").collect()}
    assert counts[1][3] == 2.0 and sum(counts[1]) == 2.0 and sum(counts[2]) == 0.0
    assert sums[1][3] == 1.0 and sum(sums[1]) == 1.0


def test_null_criterion_counts_nothing(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 2, True), (1, 2, False)], "id int, year int, c boolean")
    row = agg.zonal_histogram(df, ["id"], F.col("year"), {"n": F.col("c"), "all": F.lit(True)}).first()
    assert (row["n"], row["all"]) == (1, 3)
