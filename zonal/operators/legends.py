"""Layer codes to meanings, and area by class.

Class legends are small fixed tables joined after the area is summed per code, so the
join sees one row per code and never one per pixel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes and labels as published with each layer. Codes not listed take the default.
BIOMES = {
    1: "Caatinga",
    2: "Cerrado",
    3: "Pantanal",
    4: "Pampa",
    5: "Amazônia",
    6: "Mata Atlântica",
}

FOREST_AREA = {
    1: "Protected Forest",
    2: "Production Forest",
    3: "Limited Production Forest",
    4: "Converted Production Forest",
    5: "Other Utilization Area",
    6: "Sanctuary Reserves/Nature Conservation Area",
    7: "Marine Protected Areas",
}

LAND_COVER_2017_FLAGSHIP = {
    2001: "Primary Dry Land Forest",
    2002: "Secondary Dry Land Forest",
    2004: "Primary Mangrove Forest",
    2005: "Primary Swamp Forest",
    2006: "Plantation Forest",
    2007: "Bush / Shrub",
    2008: "",
    2010: "Estate Crop Plantation",
    2011: "",
    2012: "Settlement Area",
    2014: "Bare Land",
    2020: "",
    2092: "",
    3000: "Savannah",
    5001: "Bodies of Water",
    20021: "",
    20041: "Secondary Mangrove Forest",
    20051: "Secondary Swamp Forest",
    20071: "Swamp Shrub",
    20091: "Dryland Agriculture",
    20092: "Shrub-Mixed Dryland Farm",
    20093: "Rice Field",
    20094: "Fish Pond",
    20102: "",
    20121: "Airport\t/ Harbour",
    20122: "Transmigration Area",
    20141: "Mining Area",
    20191: "",
    50011: "Swamp",
}

LAND_COVER_2017_PRO = {
    2001: "Primary forest",
    2002: "Secondary forest",
    2004: "Primary forest",
    2005: "Primary forest",
    2006: "Timber plantation",
    2007: "Grassland/shrub",
    2008: "",
    2010: "Estate crop plantation",
    2011: "",
    2012: "Settlement",
    2014: "Bare land",
    2020: "",
    2092: "",
    3000: "Grassland/shrub",
    5001: "Body of water",
    20021: "",
    20041: "Secondary forest",
    20051: "Secondary forest",
    20071: "Swamp",
    20091: "Agriculture",
    20092: "Agriculture",
    20093: "Agriculture",
    20094: "Fish pond",
    20102: "",
    20121: "Settlement",
    20122: "Settlement",
    20141: "Mining",
    20191: "",
    50011: "Swamp",
}

PLANTATIONS = {
    1: "Fruit",
    2: "Fruit Mix",
    3: "Oil Palm ",
    4: "Oil Palm Mix",
    5: "Other",
    6: "Rubber",
    7: "Rubber Mix",
    8: "Unknown",
    9: "Unknown Mix",
    10: "Wood fiber / Timber",
    11: "Wood fiber / Timber Mix",
}

PROTECTED_AREAS = {
    1: "Category Ia/b or II",
    2: "Other Category",
}

LAND_COVER_2010 = {
    1: "Primary forest",
    2: "Secondary forest",
    3: "Primary forest",
    4: "Primary forest",
    5: "Secondary forest",
    6: "Secondary forest",
    7: "Rubber plantation",
    8: "Oil palm plantation",
    9: "Timber plantation",
    10: "Mixed tree crops",
    11: "Grassland/shrub",
    12: "Swamp",
    13: "Agriculture",
    14: "Settlements",
    15: "Grassland/shrub",
    16: "Swamp",
    17: "Agriculture",
    18: "Coastal fish pond",
    19: "Bare land",
    20: "Mining",
    21: "Water bodies",
    22: "No data",
}

# Label, bit of the region code.
REGION_BITS = {
    "South America": 1,
    "Legal Amazon": 2,
    "Brazil Biomes": 3,
    "Cerrado Biomes": 4,
    "South East Asia": 5,
    "Indonesia": 6,
}

# Upper end of a density class, label of the class; above the last end it is 75.
DENSITY_CLASSES = {10: 0, 15: 10, 20: 15, 25: 20, 30: 25, 50: 30, 75: 50}
DENSITY_TOP = 75

# layer -> (variant -> table, default label). Layers without variants use None.
LEGENDS = {
    "ibge_bra_biomes": ({None: BIOMES}, "Unknown"),
    "idn_forest_area": ({None: FOREST_AREA}, ""),
    "idn_land_cover_2017": ({"flagship": LAND_COVER_2017_FLAGSHIP, "pro": LAND_COVER_2017_PRO}, ""),
    "plantations": ({None: PLANTATIONS}, ""),
    "wdpa_protected_areas": ({None: PROTECTED_AREAS}, ""),
    "rspo_southeast_asia_land_cover_2010": ({None: LAND_COVER_2010}, "Unknown"),
}


def legend(layer: str, variant: str | None = None) -> tuple[dict[int, str], str]:
    """The code table of a layer and its default label."""
    if layer not in LEGENDS:
        raise KeyError(f"layer {layer!r} has no class legend")
    tables, default = LEGENDS[layer]
    if variant not in tables:
        raise KeyError(f"legend of {layer!r} comes in the variants {sorted(map(str, tables))}")
    return tables[variant], default


def legend_table(spark: SparkSession) -> DataFrame:
    """All class legends as rows (layer, variant, code, label); variant is '' where there is one only."""
    rows = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(variant or "").alias("variant"),
            F.lit(code).alias("code"),
            F.lit(label).alias("label"),
        )
        for layer, (tables, _) in LEGENDS.items()
        for variant, table in tables.items()
        for code, label in table.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def decode_classes(df: DataFrame) -> DataFrame:
    """Add `label` to rows carrying layer, variant and code. A NULL code keeps a NULL label."""
    # about a hundred fixed rows
    table = F.broadcast(legend_table(df.sparkSession).withColumnRenamed("label", "known"))
    default = F.lit("")
    for layer, (_, text) in LEGENDS.items():
        default = F.when(F.col("layer") == layer, F.lit(text)).otherwise(default)
    label = F.when(F.col("code").isNotNull(), F.coalesce("known", default))
    return df.join(table, ["layer", "variant", "code"], "left").withColumn("label", label).drop("known")


def decode_layer(df: DataFrame, code: str, layer: str, variant: str | None = None, label: str = "label") -> DataFrame:
    """Add the label of one layer's code column."""
    _, default = legend(layer, variant)
    table = legend_table(df.sparkSession).where((F.col("layer") == layer) & (F.col("variant") == (variant or "")))
    table = F.broadcast(table.select(F.col("code").alias("legend_code"), F.col("label").alias("legend_label")))
    joined = df.join(table, F.col(code) == F.col("legend_code"), "left")
    text = F.when(F.col(code).isNotNull(), F.coalesce("legend_label", F.lit(default)))
    return joined.withColumn(label, text).drop("legend_code", "legend_label")


def area_by_class(
    pixels: DataFrame, code: str, layer: str, variant: str | None = None, by: tuple[str, ...] = (), area: str = "area"
) -> DataFrame:
    """Area per label: summed per code first, decoded after."""
    per_code = pixels.groupBy(*by, code).agg(F.sum(area).alias("area"))
    labelled = decode_layer(per_code, code, layer, variant)
    return labelled.groupBy(*by, "label").agg(F.sum("area").alias("area"))


def areas_by_class(pixels: DataFrame, codes: dict[tuple[str, str | None], str], area: str = "area") -> DataFrame:
    """Area per layer, variant and label for several layers in one pass over the pixels.
    `codes` maps (layer, variant) to the code column."""
    for layer, variant in codes:
        legend(layer, variant)
    coded = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"), F.lit(variant or "").alias("variant"), F.col(code).cast("int").alias("code")
            )
            for (layer, variant), code in codes.items()
        ]
    )
    per_code = pixels.select(F.col(area).alias("area"), F.inline(coded)).groupBy("layer", "variant", "code")
    labelled = decode_classes(per_code.agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n")))
    return labelled.groupBy("layer", "variant", "label").agg(F.sum("area").alias("area"), F.sum("n").alias("n"))


def loss_year(code: Column) -> Column:
    """Loss code to calendar year; 0 is no loss."""
    return F.when(code != 0, code + F.lit(2000))


def density_class(percent: Column) -> Column:
    """Density in percent to the lower end of its threshold class."""
    out = F.when(percent.isNull(), F.lit(None).cast("int"))
    for upper, label in DENSITY_CLASSES.items():
        out = out.when(percent <= upper, F.lit(label))
    return out.otherwise(F.lit(DENSITY_TOP))


def density_above(percent: Column, threshold: int = 60) -> Column:
    """Boolean density layer."""
    return percent > threshold


def intact_forest_year(code: Column) -> Column:
    """Year of an intact forest landscape as text; 0 is none."""
    return F.when(code == 0, F.lit("")).when(code.isNotNull(), code.cast("string"))


def intact_forest_in(code: Column, year: int) -> Column:
    """Whether the landscape was still intact in 2000, 2013 or 2016."""
    if year == 2000:
        return code != 0
    return code.isin({2013: [2013, 2016], 2016: [2016]}[year])


def region_flag(code: Column, region: str) -> Column:
    """One boolean of the 8-bit region code."""
    return F.getbit(code, F.lit(REGION_BITS[region])) == 1


def region_flags(code: Column) -> Column:
    """All regions as MAP<STRING, BOOLEAN>."""
    entries = [item for region in REGION_BITS for item in (F.lit(region), region_flag(code, region))]
    return F.create_map(*entries)
