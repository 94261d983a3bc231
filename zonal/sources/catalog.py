"""The layer catalogue: names, source URIs, versions, and which tile files exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonal.functions.grid import Grid
from zonal.operators.coverage import segment_cover
from zonal.operators.staging import stage

LATEST = "latest"


def read_catalog(spark: SparkSession, path: str, flavor: str) -> DataFrame:
    """A JSON catalogue `{"layers": [{"name", "source_uri"}, ...]}` with its entry order."""
    schema = "layers array<struct<name:string,source_uri:string>>"
    document = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    entries = document.select(F.posexplode("layers").alias("pos", "layer"))
    return entries.select(F.lit(flavor).alias("flavor"), "pos", "layer.name", "layer.source_uri")


def first_entries(catalog: DataFrame) -> DataFrame:
    """The first URI of every name: names repeat with different products."""
    return catalog.groupBy("flavor", "name").agg(F.min_by("source_uri", "pos").alias("source_uri"))


def resolve_layers(catalog: DataFrame, wanted: DataFrame, flavor: str) -> DataFrame:
    """name -> source_uri for the wanted names of one flavour; an unknown name fails the query."""
    known = first_entries(catalog.where(F.col("flavor") == flavor)).drop("flavor")
    unknown = F.raise_error(F.concat(F.lit("no catalogue entry for layer "), F.col("name")))
    return wanted.select("name").distinct().join(known, "name", "left").select(
        "name", F.coalesce("source_uri", unknown).alias("source_uri")
    )


def substitute_latest(catalog: DataFrame, versions: DataFrame) -> DataFrame:
    """Replace `latest` in URIs by the dataset's published version (dataset, version);
    a dataset without one fails the query."""
    joined = catalog.join(versions.withColumnRenamed("dataset", "name"), "name", "left")
    missing = F.raise_error(F.concat(F.lit("no latest version for layer "), F.col("name")))
    filled = F.replace("source_uri", F.lit(LATEST), F.coalesce("version", missing))
    uri = F.when(F.contains("source_uri", F.lit(LATEST)), filled).otherwise(F.col("source_uri"))
    return joined.withColumn("source_uri", uri).select(*catalog.columns)


def malformed_uris(catalog: DataFrame) -> DataFrame:
    """Entries whose URI cannot name a tile file."""
    return catalog.where(~F.endswith("source_uri", F.lit(".tif")))


def tile_uris(files: DataFrame, grid: Grid, template: Column) -> DataFrame:
    """Add `uri` for file keys (file_col, file_row) from a layer's URI template: a literal,
    or a column when `files` was joined to a resolved catalogue."""
    tile_id = grid.tile_id(F.col("file_col"), F.col("file_row"))
    return files.withColumn("uri", grid.fill_template(template, tile_id))


def area_files(locations: DataFrame, grid: Grid) -> DataFrame:
    """Distinct file keys touched by the locations."""
    keys = segment_cover(locations, grid, unit="file").select("key_col", "key_row").distinct()
    return keys.select(F.col("key_col").alias("file_col"), F.col("key_row").alias("file_row"))


def existing_tiles(uris: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows of `uris` for which some inventory `object` starts with the URI.

    In sorted order the first object not before a URI starts with it if any object does. So URIs
    and objects are range-sorted together, each URI looks ahead within its range, and past its end
    to the next object of a later range: one row per range that every other can see.
    """
    kind, text = F.lit(0).alias("kind"), F.col("uri").alias("text")
    both = uris.select("uri").distinct().select(text, kind).unionByName(
        inventory.select(F.col("object").alias("text"), F.lit(1).alias("kind")).distinct()
    )
    sorted_ = both.where(F.col("text").isNotNull()).repartitionByRange("text", "kind")
    placed = stage(sorted_.withColumn("part", F.spark_partition_id()))
    firsts = placed.where("kind = 1").groupBy("part").agg(F.min("text").alias("first"))
    parts = placed.select("part").distinct()
    # a row per range of the sort, as many as there are shuffle partitions
    later = parts.join(F.broadcast(firsts.withColumnRenamed("part", "other")), F.col("other") > F.col("part"), "left")
    later = later.groupBy("part").agg(F.min("first").alias("beyond"))
    ahead = Window.partitionBy("part").orderBy("text", "kind").rowsBetween(1, Window.unboundedFollowing)
    following = F.first(F.when(F.col("kind") == 1, F.col("text")), ignorenulls=True).over(ahead)
    seen = placed.withColumn("following", following).where("kind = 0").join(F.broadcast(later), "part")
    found = seen.where(F.startswith(F.coalesce("following", "beyond"), F.col("text")))
    return uris.join(found.select(F.col("text").alias("uri")), "uri", "left_semi")
