"""Location tables: list_id, location_id, rings (shell first, then holes).

A location may have any number of rows; together they cover the union of their parts.
`location_id = -1` marks the area of interest of a whole list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonal.functions.grid import Grid
from zonal.operators.coverage import LOC, cell_map, coverage_cells
from zonal.sources.feature_collections import feature_texts

RINGS = "array<array<struct<x:double,y:double>>>"
AOI_ID = -1

# Fixed value: parts with more vertices than this are reported.
MANY_VERTICES = 1250


def read_geojson(
    spark: SparkSession,
    paths: str | list[str],
    properties: str = "list_id string, location_id bigint",
    one_feature_per_line: bool = False,
) -> DataFrame:
    """GeoJSON Polygon and MultiPolygon features to one row per polygon part.

    Files are FeatureCollections, or have one feature per line (`one_feature_per_line`). Either way
    Spark reads them in byte ranges: one large file feeds as many tasks as many small ones.

    No feature is lost: one with a null geometry, or without any part, is a row without rings,
    which covers nothing and is still reported. Anything that cannot be read fails the query: a
    document without features, another geometry type, missing or unreadable coordinates.
    """
    shape_type = T.StructType().add("type", "string").add("coordinates", "string")
    feature = T.StructType().add("type", "string").add("geometry", shape_type)
    feature = feature.add("properties", T.StructType.fromDDL(properties))
    if one_feature_per_line:
        lines = spark.read.option("mode", "FAILFAST").schema(feature).json(paths)
        features = lines.select(F.struct("geometry", "properties").alias("feature"))
    else:
        texts = feature_texts(spark, paths)
        features = texts.select(F.from_json("text", feature, {"mode": "FAILFAST"}).alias("feature"))
    shape, raw = F.col("feature.geometry.type"), F.col("feature.geometry.coordinates")
    raw = F.coalesce(raw, F.raise_error(F.lit("geometry without coordinates")))
    polygon = "array<array<array<double>>>"

    def read(schema: str) -> Column:
        # the parser's own strict mode fails on a NULL pointer here; what it cannot read is NULL without it
        return F.coalesce(F.from_json(raw, schema), F.raise_error(F.concat(F.lit("unreadable coordinates "), F.substring(raw, 1, 100))))

    parts = (
        F.when(F.col("feature.geometry").isNull(), F.lit(None))
        .when(shape == "Polygon", F.array(read(polygon)))
        .when(shape == "MultiPolygon", read(f"array<{polygon}>"))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported geometry type "), F.coalesce(shape, F.lit("null")))))
    )
    exploded = features.select("feature.properties.*", F.explode_outer(parts).alias("part"))
    rings = F.coalesce(_to_rings(F.col("part")), F.array().cast(RINGS))
    return exploded.select(*[c for c in exploded.columns if c != "part"], rings.alias("rings"))


def read_cell_map(
    spark: SparkSession,
    paths: str | list[str],
    grid: Grid,
    value: str = "runs",
    rule: str = "center",
    properties: str = "list_id string, location_id bigint",
    one_feature_per_line: bool = False,
) -> DataFrame:
    """GeoJSON straight to cell maps: read, split by segment, and gathered by list and segment."""
    locations = read_geojson(spark, paths, properties, one_feature_per_line)
    return cell_map(coverage_cells(locations, grid, rule), grid, value)


def _to_rings(part: Column) -> Column:
    def number(p: Column, place: int) -> Column:
        return F.coalesce(F.get(p, F.lit(place)), F.raise_error(F.lit("a position needs two numbers")))

    def point(p: Column) -> Column:
        return F.struct(number(p, 0).alias("x"), number(p, 1).alias("y"))

    return F.transform(part, lambda ring: F.transform(ring, point))


def read_locations(spark: SparkSession, path: str, list_id_type: str = "string") -> DataFrame:
    """Locations already in Parquet, with the schema stated."""
    return spark.read.schema(f"list_id {list_id_type}, location_id bigint, rings {RINGS}").parquet(path)


def vertex_counts(locations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of vertices per location (or other group)."""
    rings = F.aggregate("rings", F.lit(0).cast("bigint"), lambda n, ring: n + F.size(ring))
    return locations.groupBy(*(by or LOC)).agg(F.sum(rings).alias("n"))


def crowded_locations(locations: DataFrame, limit: int = MANY_VERTICES) -> DataFrame:
    """Locations whose vertex count is above the limit."""
    return vertex_counts(locations).where(F.col("n") > limit)


def areas_of_interest(locations: DataFrame) -> DataFrame:
    """The area-of-interest rows, at least one for each list that has any."""
    return locations.where(F.col("location_id") == AOI_ID)


def location_bounds(locations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Bounding box per location (or other group)."""
    points = locations.select(*(by or LOC), F.explode(F.flatten("rings")).alias("p"))
    return points.groupBy(*(by or LOC)).agg(
        F.min("p.x").alias("xmin"), F.min("p.y").alias("ymin"), F.max("p.x").alias("xmax"), F.max("p.y").alias("ymax")
    )
