"""Locations, tiles, pixels, points and catalogue derived from the given tables.

Everything is computed from whole tables and grows with them: a customer is a polygon,
an order is a tile, a line item is a pixel, a page is a catalogue entry.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal import Grid, Layers
from zonal.functions.grid import KEY
from zonal.operators import run_tiles
from zonal.operators.staging import staging_dir
from zonal.plans.jobs import with_pixel_area
from zonal.sources.stacks import read_stack, write_stack

WORLD = Grid()
# Same pixels, blocks of 10 x 10: one order makes one such tile.
SMALL = Grid(px_per_deg=4000, file_deg=10, block=10)
COL0, ROW0, ACROSS = 76000, 18000, 400
# Some 6 MB for each layer of 10 x 10 cells.
TILES_PER_BUCKET = 1 << 14

LAYERS = Layers()
STACK = [LAYERS.loss, LAYERS.density, LAYERS.primary, LAYERS.peat]
LISTS = 25

# Codes that occur in the 2017 land cover, and one that does not.
LAND_COVER_CODES = [
    2001, 2002, 2004, 2005, 2006, 2007, 2008, 2010, 2011, 2012, 2014, 2020, 2092, 3000, 5001,
    20021, 20041, 20051, 20071, 20091, 20092, 20093, 20094, 20102, 20121, 20122, 20141, 20191, 50011, 9999,
]

TEMPLATE = "s3://tiles/loss/v1/{grid_size}/{row_count}/year/{tile_id}.tif"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- polygons ----------------------------------------------------------------


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds in pixel units: centre (cx + 0.25, cy + 0.125), half-width w, hole half-width.
    The offsets keep every edge off pixel centres and corners."""
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    base = customer.select(
        (key % LISTS).alias("list_id"),
        F.when(key < LISTS, F.lit(-1)).otherwise(key).cast("bigint").alias("location_id"),
        (F.lit(COL0 * 10) + key * 97 % 4000).alias("cx"),
        (F.lit(ROW0 * 10 + 5) + F.floor(key / 40) * 10).alias("cy"),
        F.when(key < LISTS, F.lit(60)).otherwise(6 + key % 13).alias("w"),
        F.when(F.col("c_nationkey") % 5 == 0, 3).otherwise(0).alias("hole"),
        F.col("c_mktsegment").alias("segment"),
    )
    second = base.where("segment = 'BUILDING'").withColumns(
        {"cx": F.col("cx") + 5, "cy": F.col("cy") + 2, "hole": F.lit(0)}
    )
    return base.unionByName(second)


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diamonds as rings in degrees, with the hole as a second ring."""

    corners = F.array(
        *[
            F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
            for dx, dy in [(0, -1), (1, 0), (0, 1), (-1, 0), (0, -1)]
        ]
    )

    def corner(half: Column, at: Column) -> Column:
        return F.struct(
            ((F.col("cx") + 0.25 + half * at["dx"]) / 4000.0 - 180.0).alias("x"),
            (90.0 - (F.col("cy") + 0.125 + half * at["dy"]) / 4000.0).alias("y"),
        )

    halves = F.filter(F.array("w", F.col("hole").cast("bigint")), lambda half: half > 0)
    rings = F.transform(halves, lambda half: F.transform(corners, lambda at: corner(half, at)))
    return diamonds(spark, sf_dir).select("list_id", "location_id", rings.alias("rings"))


def hourglasses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that cross themselves in the middle of each diamond: two triangles, one above the
    other, whose signed areas cancel."""

    def corner(dx: int, dy: int) -> Column:
        return F.struct(
            ((F.col("cx") + 0.25 + F.col("w") * dx) / 4000.0 - 180.0).alias("x"),
            (90.0 - (F.col("cy") + 0.125 + F.col("w") * dy) / 4000.0).alias("y"),
        )

    ring = F.array(*[corner(dx, dy) for dx, dy in [(-1, -1), (1, -1), (-1, 1), (1, 1), (-1, -1)]])
    return diamonds(spark, sf_dir).select("list_id", "location_id", F.array(ring).alias("rings"))


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of half-width w with a spike: the ring goes out along a slanted line and back. For
    every third the ring is that line alone, and has no area at all."""

    def corner(dx, dy) -> Column:
        return F.struct(
            ((F.col("cx") + 0.25 + dx) / 4000.0 - 180.0).alias("x"), (90.0 - (F.col("cy") + 0.125 + dy) / 4000.0).alias("y")
        )

    w = F.col("w").cast("double")
    tip = corner(w * 3 + 1.5, w + 7.0)
    square = F.array(corner(-w, -w), corner(w, -w), corner(w, w), tip, corner(w, w), corner(-w, w))
    line = F.array(corner(w, w), tip, corner(w, w))
    ring = F.when(F.col("cx") % 3 == 0, line).otherwise(square)
    return diamonds(spark, sf_dir).select("list_id", "location_id", F.array(ring).alias("rings"))


def crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as diamonds in a handful of segments."""
    key = F.col("c_custkey")
    placed = table(spark, sf_dir, "customer").select(
        (key % LISTS).alias("list_id"),
        key.alias("location_id"),
        (F.lit(COL0 * 10 + 8) + key % 7).alias("cx"),
        (F.lit(ROW0 * 10 + 8) + key % 5).alias("cy"),
        (3 + key % 3).alias("w"),
    )

    def corner(dx: int, dy: int) -> Column:
        return F.struct(
            ((F.col("cx") + 0.25 + F.col("w") * dx) / 4000.0 - 180.0).alias("x"),
            (90.0 - (F.col("cy") + 0.125 + F.col("w") * dy) / 4000.0).alias("y"),
        )

    ring = F.array(*[corner(dx, dy) for dx, dy in [(0, -1), (1, 0), (0, 1), (-1, 0)]])
    return placed.select("list_id", "location_id", F.array(ring).alias("rings"))


# -- tiles -------------------------------------------------------------------


def _tile(keyed: DataFrame, layer: str, cell) -> DataFrame:
    number = F.col("k")
    return keyed.select(
        (F.lit(COL0) + number % ACROSS).cast("int").alias("key_col"),
        (F.lit(ROW0) + F.floor(number / ACROSS)).cast("int").alias("key_row"),
        F.lit(layer).alias("layer"),
        F.transform(F.sequence(F.lit(0), F.lit(99)), cell).alias("cells"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 10 x 10 tile per order and layer. Peat comes from line items, so orders without
    any have no peat tile; segments past the last order have no tile at all."""
    k, m = F.col("k"), F.col("m")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("m"))
    # a row grows to a hundred cells per layer: spread the rows of one small file before that
    orders = orders.repartition(spark.sparkContext.defaultParallelism, "k")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_suppkey").alias("m"))
    # reduce the numbers first, so that the cells are int arithmetic
    orders = orders.select(
        "k",
        (k % 17).cast("int").alias("k17"),
        (k * 7 % 24).cast("int").alias("k24"),
        (k % 3).cast("int").alias("k3"),
        (m % 101).cast("int").alias("m101"),
    )
    lines = lines.select("k", (m % 5).cast("int").alias("m5"))
    loss = _tile(
        orders, LAYERS.loss, lambda i: F.when((F.col("k17") + i) % 17 != 0, (F.col("k24") + i * 13) % 24)
    )
    density = _tile(orders, LAYERS.density, lambda i: (F.col("m101") + i * 31) % 101)
    primary = _tile(orders, LAYERS.primary, lambda i: ((F.col("k3") + i) % 3 == 0).cast("int"))
    peat = _tile(lines, LAYERS.peat, lambda i: ((F.col("m5") + i) % 5 == 0).cast("int"))
    return loss.unionByName(density).unionByName(primary).unionByName(peat)


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles written as a stacked table, and read back."""
    path = new_path(spark, "stack")
    buckets = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "orders").count() // TILES_PER_BUCKET))
    write_stack(tiles(spark, sf_dir), path, SMALL, STACK, buckets=buckets)
    return read_stack(spark, path)


def run_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stacked table with its tiles as runs."""
    held = stack(spark, sf_dir)
    return held.select("segment", *KEY, *[run_tiles.to_runs(F.col(c)).alias(c) for c in STACK])


def land_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile of land cover codes per order."""
    codes = F.array(*[F.lit(c) for c in LAND_COVER_CODES])
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    first = (F.col("k") % len(LAND_COVER_CODES)).cast("int")
    orders = orders.repartition(spark.sparkContext.defaultParallelism, "k")
    return _tile(orders, "land", lambda i: F.get(codes, (first + i) % len(LAND_COVER_CODES)))


# -- files -------------------------------------------------------------------


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_dir(spark)}/suite-{name}-{uuid.uuid4().hex}"


def geojson(spark: SparkSession, sf_dir: str) -> str:
    """The path of one collection on one line: a feature per diamond, with braces in its strings."""
    rings = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    properties = F.struct("list_id", "location_id", F.lit('a "}" in {[text').alias("note"))
    geometry = F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))
    text = F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))
    features = locations(spark, sf_dir).select(F.lit(1).alias("place"), F.xxhash64("location_id", "rings").alias("n"), text.alias("value"))
    first = features.agg(F.min("n")).first()[0]
    features = features.withColumn("value", F.concat(F.when(F.col("n") == first, F.lit("")).otherwise(F.lit(",")), "value"))
    ends = [(0, 0, '{"type":"FeatureCollection","features":['), (2, 0, "]}")]
    whole = features.unionByName(spark.createDataFrame(ends, "place int, n bigint, value string"))
    path = new_path(spark, "geojson")
    whole.coalesce(1).sortWithinPartitions("place", "n").select("value").write.option("lineSep", " ").text(path)
    return path


def catalog_file(spark: SparkSession, sf_dir: str, flavor: str) -> str:
    """The path of a JSON catalogue of one flavour, in the order of its entries."""
    entries = catalog(spark, sf_dir).where(F.col("flavor") == flavor).select("pos", F.to_json(F.struct("name", "source_uri")).alias("value"))
    first = entries.agg(F.min("pos")).first()[0]
    entries = entries.withColumn("value", F.concat(F.when(F.col("pos") == first, F.lit('{"layers":[')).otherwise(F.lit(",")), "value"))
    end = entries.agg(F.max("pos")).first()[0]
    whole = entries.unionByName(spark.createDataFrame([(end + 1, "]}")], "pos bigint, value string"))
    path = new_path(spark, "catalog")
    whole.coalesce(1).sortWithinPartitions("pos").select("value").write.text(path)
    return path


# -- pixels ------------------------------------------------------------------


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per line item, spread over the default grid."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(
        (supp % 4).alias("list_id"),
        F.when(part % 10 == 0, F.lit(-1)).otherwise(part % 10).cast("bigint").alias("location_id"),
        (supp * 37 % 3600).cast("int").alias("key_col"),
        (part * 17 % 1800).cast("int").alias("key_row"),
        F.when(F.col("l_discount") != 0, F.floor("l_quantity").cast("int") % 24).alias(LAYERS.loss),
        (F.floor("l_extendedprice") % 101).cast("int").alias(LAYERS.density),
        (F.col("l_returnflag") == "R").cast("int").alias(LAYERS.primary),
        (F.col("l_linestatus") == "O").cast("int").alias(LAYERS.peat),
        (part % 4).cast("int").alias(LAYERS.intact),
        (part % 3).cast("int").alias(LAYERS.protected),
        (supp % 2).cast("int").alias(LAYERS.soy),
        F.col("l_linenumber").alias("line"),
        part.alias("code"),
    )
    return with_pixel_area(rows, WORLD)


# -- points ------------------------------------------------------------------


def points(spark: SparkSession, sf_dir: str, name: str = "customer", key: str = "c_custkey") -> DataFrame:
    """A point in hundredths of a degree per row of a table."""
    number = F.col(key)
    return table(spark, sf_dir, name).select(
        (number * 7919 % 36000 / 100.0 - 180.0).alias("x"), (number * 104729 % 18000 / 100.0 - 90.0).alias("y")
    )


def point_files(spark: SparkSession, sf_dir: str, name: str = "customer", key: str = "c_custkey") -> DataFrame:
    """The file key of each point."""
    at = WORLD.point_key(F.col("x"), F.col("y"))
    keyed = points(spark, sf_dir, name, key).select(at.alias("at"))
    return keyed.select(
        WORLD.file_of_key(F.col("at.col")).alias("file_col"), WORLD.file_of_key(F.col("at.row")).alias("file_row")
    )


# -- catalogue ---------------------------------------------------------------


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer entry per page: the host is the name, so names repeat with different URIs."""
    page = F.col("page_id")
    host = F.regexp_extract("url", "//([^/]+)/", 1)
    version = F.when(page % 4 == 0, F.lit("latest")).otherwise(F.concat(F.lit("v"), (page % 9).cast("string")))
    ending = F.when(page % 10 == 3, F.lit('.tif"')).otherwise(F.lit(".tif"))
    return table(spark, sf_dir, "pages").select(
        F.when(F.startswith("url", F.lit("https")), "pro").otherwise("default").alias("flavor"),
        page.alias("pos"),
        host.alias("name"),
        F.concat(
            F.lit("s3://tiles/"), host, F.lit("/"), version, F.lit("/{grid_size}/{row_count}/{tile_id}"), ending
        ).alias("source_uri"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published version of each dataset."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "//([^/]+)/", 1).alias("dataset"), "page_id")
    newest = pages.groupBy("dataset").agg(F.max("page_id").alias("newest"))
    return newest.select("dataset", F.concat(F.lit("v"), F.col("newest").cast("string")).alias("version"))
