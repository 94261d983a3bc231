from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zonal.operators import legends


def labels(spark, layer, codes, variant=None):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code int")
    return [r["label"] for r in legends.decode_layer(df, "code", layer, variant).orderBy("i").collect()]


def test_class_labels(spark):
    assert labels(spark, "ibge_bra_biomes", [5, 6, 0, None]) == ["Amazônia", "Mata Atlântica", "Unknown", None]
    assert labels(spark, "idn_forest_area", [6, 8]) == ["Sanctuary Reserves/Nature Conservation Area", ""]
    assert labels(spark, "plantations", [3, 11, 12]) == ["Oil Palm ", "Wood fiber / Timber Mix", ""]
    assert labels(spark, "wdpa_protected_areas", [1, 2, 3]) == ["Category Ia/b or II", "Other Category", ""]
    assert labels(spark, "rspo_southeast_asia_land_cover_2010", [4, 6, 15, 22, 23]) == [
        "Primary forest", "Secondary forest", "Grassland/shrub", "No data", "Unknown",
    ]
    assert labels(spark, "idn_land_cover_2017", [20121, 5001, 2008, 7], "flagship") == ["Airport\t/ Harbour", "Bodies of Water", "", ""]
    assert labels(spark, "idn_land_cover_2017", [20121, 2004, 50011], "pro") == ["Settlement", "Primary forest", "Swamp"]


def test_unknown_legends():
    with pytest.raises(KeyError):
        legends.legend("idn_land_cover_2017")
    with pytest.raises(KeyError):
        legends.legend("peatlands")


def column(spark, codes, make):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c int")
    return [r["v"] for r in df.orderBy("i").select(make(F.col("c")).alias("v")).collect()]


def test_rules(spark):
    assert column(spark, [0, 1, 20, None], legends.loss_year) == [None, 2001, 2020, None]
    assert column(spark, [0, 10, 11, 15, 20, 25, 30, 31, 50, 75, 76, None], legends.density_class) == [
        0, 0, 10, 10, 15, 20, 25, 30, 30, 50, 75, None,
    ]
    assert column(spark, [60, 61, None], legends.density_above) == [False, True, None]
    assert column(spark, [0, 2013, None], legends.intact_forest_year) == ["", "2013", None]
    assert column(spark, [0, 2000, 2013, 2016], lambda c: legends.intact_forest_in(c, 2000)) == [False, True, True, True]
    assert column(spark, [0, 2000, 2013, 2016], lambda c: legends.intact_forest_in(c, 2013)) == [False, False, True, True]
    assert column(spark, [0, 2000, 2013, 2016], lambda c: legends.intact_forest_in(c, 2016)) == [False, False, False, True]


def test_region_flags(spark):
    got = column(spark, [0, 2 + 16, 64], legends.region_flags)
    assert not any(got[0].values()) and len(got[0]) == 6
    assert {k for k, v in got[1].items() if v} == {"South America", "Cerrado Biomes"}
    assert {k for k, v in got[2].items() if v} == {"Indonesia"}


def test_area_by_class_merges_codes_of_a_label(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 1.0), (4, 0.5), (99, 4.0)], "code int, area double")
    got = {r["label"]: r["area"] for r in legends.area_by_class(df, "code", "rspo_southeast_asia_land_cover_2010").collect()}
    assert got == {"Primary forest": 3.5, "Unknown": 4.0}
