"""One query per operator. Each takes (spark, sf_dir) and returns flat scalar columns;
maps are unfolded to (bucket, value) rows and areas rounded, so results can be hashed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite import inputs
from suite.inputs import LAYERS, SMALL, STACK, TEMPLATE, WORLD
from zonal.functions import tile_algebra as ta
from zonal.functions.geodesy import pixel_area_ha
from zonal.functions.grid import KEY, extent_ring, grid_id_to_bounds, point_grid_id
from zonal.operators import aggregates as agg
from zonal.operators import coverage as cov
from zonal.operators import layers as lay
from zonal.operators import legends, run_tiles
from zonal.operators.staging import stage
from zonal.operators.two_level import two_level_cells
from zonal.plans import analyses as plans
from zonal.plans import classes, jobs, summaries
from zonal.sources import catalog as cat
from zonal.sources import locations as loc
from zonal.sources.results import write_results
from zonal.sources.tiles import read_tiles, tile_summary, write_tiles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BY = ["list_id", "location_id"]
DIGITS = 5


def query(run: Query) -> Query:
    """Register a query under its function name, with all integers as BIGINT."""

    def widened(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        small = (T.IntegerType, T.ShortType, T.ByteType)
        return df.select(
            *[F.col(f.name).cast("bigint") if isinstance(f.dataType, small) else F.col(f.name) for f in df.schema]
        )

    QUERIES[run.__name__] = widened
    return run


def rounded(df: DataFrame, names: list[str], digits: int = DIGITS) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def cell_sum(tile: Column) -> Column:
    return F.aggregate(tile, F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x, F.lit(0)))


def cell_count(tile: Column) -> Column:
    return F.size(F.filter(tile, lambda x: x.isNotNull()))


def stacked(spark: SparkSession, sf_dir: str, layers: list[str]) -> DataFrame:
    """Layers side by side for every key of the first one."""
    tiles = inputs.tiles(spark, sf_dir)
    return lay.join_layers(lay.layer_tiles(tiles, layers[0]), tiles, layers[1:])


# -- jobs ----------------------------------------------------------------------


@query
def fcd_pixelwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyses = plans.standard_analyses()
    names = [a.name for a in analyses]
    totals = jobs.pixelwise_totals(inputs.pixels(spark, sf_dir), analyses, LAYERS.loss)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_polygons_pixelwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [a.name for a in plans.standard_analyses()]
    totals = jobs.loss_by_year_pixelwise(inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [a.name for a in plans.standard_analyses()]
    totals = jobs.loss_by_year_histogram(inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_histogram_all_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [a.name for a in plans.standard_analyses()]
    totals = jobs.loss_by_year_histogram(
        inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL, rule="all_touched"
    )
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly maps and areas in one report; further layers stand in for those without tiles."""
    layers = replace(LAYERS, intact=LAYERS.primary, protected=LAYERS.peat, soy=LAYERS.primary)
    analyses = plans.extended_analyses(layers)
    yearly, areas = [a.name for a in analyses if a.yearly], [a.name for a in analyses if not a.yearly]
    totals = jobs.loss_by_year_histogram(
        inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL, layers, analyses
    )
    return rounded(agg.map_rows(totals, [*BY, *areas], yearly), [*yearly, *areas])


@query
def fcd_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from a stacked table, whose cells stay in their buckets."""
    names = [a.name for a in plans.standard_analyses()]
    totals = jobs.loss_by_year_histogram(inputs.locations(spark, sf_dir), inputs.stack(spark, sf_dir), SMALL)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from summaries of whole segments, and cells along borders."""
    analyses = plans.standard_analyses()
    names, held, path = [a.name for a in analyses], inputs.stack(spark, sf_dir), inputs.new_path(spark, "summaries")
    summaries.write_summaries(held, path, SMALL, analyses, LAYERS.loss)
    made = summaries.read_summaries(spark, path, analyses)
    totals = summaries.loss_by_year_two_level(inputs.locations(spark, sf_dir), held, made, SMALL)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from prefix sums, without reading a cell."""
    analyses = plans.standard_analyses()
    names, held, path = [a.name for a in analyses], inputs.stack(spark, sf_dir), inputs.new_path(spark, "prefixes")
    summaries.write_prefixes(held, path, SMALL, analyses, LAYERS.loss)
    made = summaries.read_prefixes(spark, path, analyses)
    totals = summaries.loss_by_year_prefix(inputs.locations(spark, sf_dir), held, made, SMALL)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def fcd_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All locations in a few segments: hot keys are dealt out. Summed by list."""
    analyses = plans.standard_analyses()
    names = [a.name for a in analyses]
    totals = jobs.loss_by_year_histogram(inputs.crowd(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL, rows_per_task=64)
    rows = agg.map_rows(totals, BY, names)
    return rounded(rows.groupBy("list_id", "bucket").agg(*[F.sum(n).alias(n) for n in names]), names, 4)


@query
def area_by_class_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hectares of every land cover class in every location, from maps of its codes."""
    areas = classes.class_areas(inputs.locations(spark, sf_dir), inputs.land_tiles(spark, sf_dir), "land", SMALL)
    held = classes.class_maps(areas).select(*BY, F.explode("areas").alias("code", "area"))
    return rounded(classes.labelled_areas(held, "idn_land_cover_2017", "pro"), ["area"])


@query
def area_by_class_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per list and code, as a sum of maps."""
    areas = classes.class_areas(inputs.locations(spark, sf_dir), inputs.land_tiles(spark, sf_dir), "land", SMALL)
    summed = classes.add_class_maps(classes.class_maps(areas), ["list_id"])
    return rounded(summed.select("list_id", F.explode("areas").alias("code", "area")), ["area"], 4)


@query
def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as JSON, with map keys as text, and read back."""
    names = [a.name for a in plans.standard_analyses()]
    totals = jobs.loss_by_year_histogram(inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL)
    path = inputs.new_path(spark, "results")
    write_results(totals, path)
    schema = "list_id bigint, location_id bigint, " + ", ".join(f"{n} map<string,double>" for n in names)
    back = spark.read.schema(schema).json(path)
    slots = back.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(agg.BUCKETS - 1))))
    values = [F.element_at(n, F.col("bucket").cast("string")).alias(n) for n in names]
    return rounded(slots.select(*BY, "bucket", *values), names)


@query
def extended_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyses = [a for a in plans.extended_analyses() if not a.yearly]
    totals = jobs.scalar_totals(inputs.pixels(spark, sf_dir), analyses)
    return rounded(totals, [a.name for a in analyses])


@query
def extended_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyses = [a for a in plans.extended_analyses() if a.yearly]
    names = [a.name for a in analyses]
    totals = jobs.pixelwise_totals(inputs.pixels(spark, sf_dir), analyses, LAYERS.loss)
    return rounded(agg.map_rows(totals, BY, names), names)


@query
def analysis_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyses = plans.standard_analyses()
    added = plans.add_columns(inputs.pixels(spark, sf_dir), analyses)
    return rounded(added.groupBy(*BY).agg(*plans.agg_columns(analyses)), [a.name for a in analyses])


# -- aggregates ----------------------------------------------------------------


@query
def loss_year_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = inputs.pixels(spark, sf_dir)
    totals = agg.loss_year_agg(pixels, BY, F.col(LAYERS.loss), {"area": F.col("area")}, strict=True)
    return rounded(agg.map_rows(totals, BY, ["area"]), ["area"])


@query
def pixel_agg_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area per id and calendar year under two criteria."""
    pixels = inputs.pixels(spark, sf_dir)
    measures = {
        "area_gt90": F.when(F.col(LAYERS.density) > 90, F.col("area")),
        "area_lt30": F.when(F.col(LAYERS.density) < 30, F.col("area")),
    }
    year = legends.loss_year(F.col(LAYERS.loss))
    long = agg.sums_by_bucket(pixels.withColumn("id", F.col("list_id")), ["id"], year, measures)
    return rounded(long.withColumnRenamed("bucket", "loss_year"), list(measures))


@query
def histogram_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = lay.layer_tiles(inputs.tiles(spark, sf_dir), LAYERS.loss)
    hists = agg.tile_histograms(tiles, [*KEY], LAYERS.loss, None, SMALL, "total")
    hists = hists.select((F.col("key_col") % 4).alias("list_id"), "total")
    return agg.map_rows(agg.histogram_agg(hists, ["list_id"], ["total"]), ["list_id"], ["total"])


@query
def histogram_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = stacked(spark, sf_dir, [LAYERS.loss, LAYERS.primary])
    hists = agg.tile_histograms(tiles, [*KEY], LAYERS.loss, LAYERS.primary, SMALL, "hist")
    scaled = hists.select(*KEY, agg.scale_histogram(F.col("hist"), pixel_area_ha(SMALL, F.col("key_row"))).alias("h"))
    rows = scaled.select(*KEY, F.posexplode("h").alias("bucket", "area"))
    return rounded(rows, ["area"], 6)


@query
def zonal_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = lay.covered_values(
        inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), [LAYERS.loss, LAYERS.density], SMALL
    )
    counts = agg.zonal_histogram(
        pixels.where(F.col(LAYERS.loss).isNotNull()),
        [*BY, *KEY],
        F.col(LAYERS.loss),
        {"n": F.lit(True), "n_dense": F.col(LAYERS.density) > 30},
    )
    return counts


@query
def zonal_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zonal histogram from prefix sums: two look-ups for a run of cells."""
    analyses = [plans.Analysis("n", ()), plans.Analysis("n_dense", ((LAYERS.density, 30),))]
    names = [a.name for a in analyses]
    path = inputs.new_path(spark, "prefixes")
    summaries.write_prefixes(inputs.stack(spark, sf_dir), path, SMALL, analyses, LAYERS.loss)
    runs = stage(cov.coverage_runs(inputs.locations(spark, sf_dir), SMALL))
    return summaries.zonal_prefix(runs, summaries.read_prefixes(spark, path, analyses), [*BY, *KEY], names)


# -- grid ----------------------------------------------------------------------


@query
def pixel_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = inputs.points(spark, sf_dir).select(WORLD.point_key(F.col("x"), F.col("y"))["row"].alias("key_row"))
    rows = keyed.groupBy("key_row").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("key_row", "n", F.round(pixel_area_ha(WORLD, F.col("key_row")), 8).alias("area_ha"))


@query
def points_per_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid_id = point_grid_id(F.col("x"), F.col("y"), 10)
    return inputs.points(spark, sf_dir).groupBy(grid_id.alias("grid_id")).agg(F.count(F.lit(1)).alias("n"))


@query
def glad_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid_id = point_grid_id(F.col("x"), F.col("y"), 10)
    ids = inputs.points(spark, sf_dir).select(grid_id.alias("grid_id")).distinct()
    return ids.select("grid_id", grid_id_to_bounds(F.col("grid_id")).alias("glad_id"))


@query
def tile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = inputs.points(spark, sf_dir).select(WORLD.point_key(F.col("x"), F.col("y")).alias("k"))
    extents = keyed.select(WORLD.key_extent(F.col("k.col"), F.col("k.row")).alias("extent"))
    keys = extents.select(WORLD.extent_key(F.col("extent")).alias("k"))
    return keys.groupBy(F.col("k.col").alias("key_col"), F.col("k.row").alias("key_row")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def tile_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = lay.layer_tiles(inputs.tiles(spark, sf_dir), LAYERS.density).select(*KEY)
    extents = keys.withColumn("e", SMALL.key_extent(F.col("key_col"), F.col("key_row")))
    ringed = extents.withColumn("ring", extent_ring(F.col("e")))
    sides = ["xmin", "ymin", "xmax", "ymax"]
    return ringed.select(
        *KEY,
        *[F.round(F.col(f"e.{s}"), 7).alias(s) for s in sides],
        F.size("ring").alias("vertices"),
        F.round(F.aggregate("ring", F.lit(0.0), lambda t, p: t + p["x"]), 6).alias("sum_x"),
        F.round(F.aggregate("ring", F.lit(0.0), lambda t, p: t + p["y"]), 6).alias("sum_y"),
    )


@query
def pixel_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles with NaN for NoData to integer years."""
    code = F.coalesce(F.col(LAYERS.loss).cast("double"), F.lit(float("nan")))
    years = inputs.pixels(spark, sf_dir).select(ta.calendar_year(code).alias("loss_year"))
    return years.where(F.col("loss_year").isNotNull()).groupBy("loss_year").agg(F.count(F.lit(1)).alias("n"))


# -- locations and coverage ------------------------------------------------------


@query
def locations_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = inputs.locations(spark, sf_dir)
    return parts.groupBy(*BY).agg(F.count(F.lit(1)).alias("n_parts"), F.sum(F.size("rings")).alias("n_rings"))


@query
def locations_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection on one line, read in byte ranges."""
    parts = loc.read_geojson(spark, inputs.geojson(spark, sf_dir), "list_id bigint, location_id bigint")
    return parts.groupBy(*BY).agg(F.count(F.lit(1)).alias("n_parts"), F.sum(F.size("rings")).alias("n_rings"))


@query
def cell_map_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From GeoJSON text to cell maps in one call."""
    maps = loc.read_cell_map(spark, inputs.geojson(spark, sf_dir), SMALL, properties="list_id bigint, location_id bigint")
    n = F.aggregate("runs", F.lit(0), lambda t, run: t + run["i1"] - run["i0"])
    return cov.explode_cell_map(maps).select("list_id", *KEY, "location_id", n.alias("n"))


@query
def vertex_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loc.vertex_counts(inputs.locations(spark, sf_dir))


@query
def crowded_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loc.crowded_locations(inputs.locations(spark, sf_dir), limit=10)


@query
def aoi_per_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = loc.areas_of_interest(inputs.locations(spark, sf_dir))
    return rounded(loc.location_bounds(areas, ["list_id"]), ["xmin", "ymin", "xmax", "ymax"], 7)


@query
def segment_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cov.segment_cover(inputs.locations(spark, sf_dir), SMALL)


@query
def area_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.area_files(inputs.locations(spark, sf_dir), SMALL)


@query
def coverage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = cov.coverage_runs(inputs.locations(spark, sf_dir), SMALL)
    pixels = F.col("c1") - F.col("c0")
    moment = pixels * F.col("r")
    return runs.groupBy(*BY, *KEY).agg(F.sum(pixels).alias("n_pixels"), F.sum(moment).alias("sum_r"))


@query
def coverage_crossing_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = cov.coverage_runs(inputs.hourglasses(spark, sf_dir), SMALL)
    pixels = F.col("c1") - F.col("c0")
    return runs.groupBy(*BY, *KEY).agg(F.sum(pixels).alias("n_pixels"), F.sum(pixels * F.col("r")).alias("sum_r"))


@query
def coverage_all_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL, rule="all_touched")
    return cells.select(*BY, *KEY, "n_pixels")


@query
def coverage_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that a ring runs along twice still touch the pixels they pass."""
    cells = cov.coverage_cells(inputs.spikes(spark, sf_dir), SMALL, rule="all_touched")
    return cells.select(*BY, *KEY, "n_pixels")


@query
def spikes_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments that spikes touch."""
    return cov.segment_cover(inputs.spikes(spark, sf_dir), SMALL)


@query
def two_level_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage with whole segments as flags; a flag is worth a segment of pixels."""
    return two_level_cells(inputs.locations(spark, sf_dir), SMALL).select(*BY, *KEY, "n_pixels")


@query
def coverage_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = cov.coverage_pixels(inputs.locations(spark, sf_dir), SMALL)
    row = F.col("key_row") * SMALL.block + F.col("r")
    column = F.col("key_col") * SMALL.block + F.col("c")
    # a row of pixels by its segment row and its place there: so the pixels lie where they were made
    rows = pixels.groupBy(*BY, "key_row", "r").agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("sum_c"))
    return rows.select(*BY, row.alias("r"), "n", "sum_c")


@query
def coverage_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    mask = cells.select(*BY, *KEY, cov.dense_mask(F.col("runs"), SMALL.cells).alias("mask"))
    weighted = F.zip_with("mask", F.sequence(F.lit(0), F.lit(99)), lambda m, i: m * i)
    return mask.select(*BY, *KEY, F.size("mask").alias("cells"), cell_sum(F.col("mask")).alias("n"), cell_sum(weighted).alias("sum_i"))


@query
def covered_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cov.covered_pixels(inputs.locations(spark, sf_dir), SMALL, ["list_id"])


@query
def cell_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    rows = cov.explode_cell_map(cov.cell_map(cells, SMALL))
    n = F.aggregate("runs", F.lit(0), lambda t, run: t + run["i1"] - run["i0"])
    return rows.select("list_id", *KEY, "location_id", n.alias("n"))


@query
def cell_map_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    maps = cov.cell_map(cells, SMALL, value="mask", max_entries=2)
    rows = cov.explode_cell_map(maps, "mask")
    return rows.select("list_id", *KEY, "location_id", cell_sum(F.col("mask")).alias("n"))


# -- tiles -----------------------------------------------------------------------


@query
def tile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tile_summary(inputs.tiles(spark, sf_dir))


@query
def stored_tile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a tile table on disk."""
    path = inputs.new_path(spark, "tiles")
    write_tiles(inputs.tiles(spark, sf_dir), path, SMALL)
    return tile_summary(read_tiles(spark, path))


@query
def stacked_tile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with data per layer, side by side in one scan."""
    held = inputs.stack(spark, sf_dir)
    counts = [F.coalesce(cell_count(F.coalesce(F.col(c), F.array())), F.lit(0)).alias(f"n_{i}") for i, c in enumerate(STACK)]
    return held.select(*KEY, *counts)


@query
def tile_coverage_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile of each location's segments under its coverage, as runs."""
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    cells = cells.withColumn("segment", SMALL.segment(F.col("key_col"), F.col("key_row")))
    tiles = inputs.stack(spark, sf_dir).select("segment", LAYERS.loss)
    by = [*BY, *KEY]
    return run_tiles.cell_counts(run_tiles.masked_by_coverage(cells, tiles, by, LAYERS.loss, ("segment",)), by)


def run_totals(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sum and number of the cells of every tile, also of those that have none."""
    # the stack is written: each reader takes the layers it needs from there, and their runs are kept nowhere
    tiles = inputs.run_stack(spark, sf_dir)
    counted = run_tiles.cell_counts(make(tiles), ["segment"])
    joined = tiles.select("segment", *KEY).join(counted, "segment", "left")
    return joined.select(*KEY, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "n")])


@query
def tile_runs_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(spark, sf_dir, lambda t: run_tiles.multiply(t, ["segment"], LAYERS.loss, LAYERS.density))


@query
def tile_runs_greater(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(spark, sf_dir, lambda t: run_tiles.greater(t, ["segment"], LAYERS.loss, 12))


@query
def tile_runs_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(spark, sf_dir, lambda t: run_tiles.mask(t, ["segment"], LAYERS.density, LAYERS.loss))


@query
def tile_runs_mask_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(spark, sf_dir, lambda t: run_tiles.mask_by_value(t, ["segment"], LAYERS.density, LAYERS.primary, 0))


@query
def tile_runs_criterion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(spark, sf_dir, lambda t: run_tiles.criterion(t, ["segment"], LAYERS.loss, LAYERS.peat, 0))


@query
def tile_runs_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = inputs.run_stack(spark, sf_dir)
    return tiles.select(*KEY, *[run_tiles.largest(F.col(c)).alias(f"max_{i}") for i, c in enumerate(STACK)])


@query
def tile_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = inputs.tiles(spark, sf_dir)
    return tiles.select("layer", *KEY, ta.tile_max(F.col("cells")).alias("max_cell"))


@query
def tile_local_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ta.local_multiply(F.col(LAYERS.loss), F.col(LAYERS.density))
    tiles = stacked(spark, sf_dir, [LAYERS.loss, LAYERS.density]).select(*KEY, out.alias("t"))
    return tiles.select(*KEY, cell_sum(F.col("t")).alias("total"), cell_count(F.col("t")).alias("n"))


@query
def tile_local_greater(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = lay.layer_tiles(inputs.tiles(spark, sf_dir), LAYERS.loss)
    tiles = tiles.select(*KEY, ta.local_greater(F.col(LAYERS.loss), 12).alias("t"))
    return tiles.select(*KEY, cell_sum(F.col("t")).alias("total"), cell_count(F.col("t")).alias("n"))


@query
def tile_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = stacked(spark, sf_dir, [LAYERS.density, LAYERS.loss])
    tiles = tiles.select(*KEY, ta.mask(F.col(LAYERS.density), F.col(LAYERS.loss)).alias("t"))
    return tiles.select(*KEY, cell_sum(F.col("t")).alias("total"), cell_count(F.col("t")).alias("n"))


@query
def tile_mask_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = stacked(spark, sf_dir, [LAYERS.density, LAYERS.primary])
    tiles = tiles.select(*KEY, ta.mask_by_value(F.col(LAYERS.density), F.col(LAYERS.primary), 0).alias("t"))
    return tiles.select(*KEY, cell_sum(F.col("t")).alias("total"), cell_count(F.col("t")).alias("n"))


@query
def criterion_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = stacked(spark, sf_dir, [LAYERS.loss, LAYERS.density, LAYERS.primary])
    loss = F.col(LAYERS.loss)
    named = {
        "dense30": ta.criterion_tile(loss, F.col(LAYERS.density), 30),
        "dense90": ta.criterion_tile(loss, F.col(LAYERS.density), 90),
        "in_primary": ta.criterion_tile(loss, F.col(LAYERS.primary), 0),
    }
    return tiles.select(*KEY, *[cell_sum(t).alias(n) for n, t in named.items()])


@query
def tile_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = [LAYERS.loss, LAYERS.density, LAYERS.peat]
    cells = lay.explode_tiles(stacked(spark, sf_dir, layers), layers, SMALL)
    return cells.groupBy("key_row", "cell").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{i}") for i, c in enumerate(layers)]
    )


@query
def layer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = stacked(spark, sf_dir, STACK)
    return tiles.select(*KEY, *[cell_sum(F.col(c)).alias(f"sum_{i}") for i, c in enumerate(STACK)])


@query
def layer_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys come from the locations, so some have no tile of a layer."""
    keys = cov.segment_cover(inputs.locations(spark, sf_dir), SMALL).select(*KEY).distinct()
    layers = [LAYERS.density, LAYERS.peat]
    joined = lay.join_layers(keys, inputs.tiles(spark, sf_dir), layers)
    return joined.select(*KEY, *[cell_sum(F.col(c)).alias(f"sum_{i}") for i, c in enumerate(layers)])


@query
def spatial_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lay.spatial_join(inputs.locations(spark, sf_dir), inputs.tiles(spark, sf_dir), SMALL)
    return pairs.groupBy(*BY, *KEY).agg(F.count(F.lit(1)).alias("n_layers"))


@query
def locations_with_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    held = lay.locations_with_tiles(cells, inputs.tiles(spark, sf_dir), LAYERS.peat, SMALL)
    return held.select(*BY, *KEY, "n_pixels", cell_sum(F.col(LAYERS.peat)).alias("tile_sum"))


@query
def locations_with_tiles_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cov.coverage_cells(inputs.locations(spark, sf_dir), SMALL)
    held = lay.locations_with_tiles(cells, inputs.tiles(spark, sf_dir), LAYERS.peat, SMALL, how="left")
    return held.select(*BY, *KEY, "n_pixels", cell_sum(F.col(LAYERS.peat)).alias("tile_sum"))


@query
def aoi_tile_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = lay.area_tiles(inputs.tiles(spark, sf_dir), inputs.locations(spark, sf_dir), SMALL)
    return tiles.select("layer", *KEY, cell_sum(F.col("cells")).alias("total"))


# -- catalogue ---------------------------------------------------------------------


@query
def catalog_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = inputs.catalog(spark, sf_dir)
    wanted = catalog.where("flavor = 'pro'").select("name")
    return cat.resolve_layers(catalog, wanted, "pro")


@query
def catalog_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers resolved from a catalogue on disk."""
    catalog = cat.read_catalog(spark, inputs.catalog_file(spark, sf_dir, "default"), "default")
    return cat.resolve_layers(catalog, catalog.select("name"), "default")


@query
def catalog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.substitute_latest(inputs.catalog(spark, sf_dir), inputs.versions(spark, sf_dir))


@query
def catalog_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.malformed_uris(inputs.catalog(spark, sf_dir))


@query
def tile_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.point_files(spark, sf_dir)
    counted = files.groupBy("file_col", "file_row").agg(F.count(F.lit(1)).alias("n"))
    return cat.tile_uris(counted, WORLD, F.lit(TEMPLATE)).select("uri", "n")


@query
def tile_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files asked for by customers that exist among the suppliers' objects."""
    asked = cat.tile_uris(inputs.point_files(spark, sf_dir).distinct(), WORLD, F.lit(TEMPLATE))
    stored = cat.tile_uris(inputs.point_files(spark, sf_dir, "supplier", "s_suppkey"), WORLD, F.lit(TEMPLATE))
    inventory = stored.select(F.concat("uri", F.lit(".aux.xml")).alias("object"))
    return cat.existing_tiles(asked.select("uri"), inventory)


# -- legends -----------------------------------------------------------------------


def legend_codes(pixels: DataFrame) -> DataFrame:
    code = F.col("code")
    land = F.array(*[F.lit(c) for c in inputs.LAND_COVER_CODES])
    return pixels.withColumns(
        {
            "biome": code % 8,
            "forest": code % 9,
            "land": F.get(land, (code % len(inputs.LAND_COVER_CODES)).cast("int")),
            "plantation": code % 13,
            "protected": code % 4,
            "land2010": code % 24,
        }
    )


@query
def decode_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = {
        ("ibge_bra_biomes", None): "biome",
        ("idn_forest_area", None): "forest",
        ("idn_land_cover_2017", "flagship"): "land",
        ("idn_land_cover_2017", "pro"): "land",
        ("plantations", None): "plantation",
        ("wdpa_protected_areas", None): "protected",
        ("rspo_southeast_asia_land_cover_2010", None): "land2010",
    }
    return rounded(legends.areas_by_class(legend_codes(inputs.pixels(spark, sf_dir)), codes), ["area"])


@query
def area_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = legend_codes(inputs.pixels(spark, sf_dir))
    classes = legends.area_by_class(pixels, "land", "idn_land_cover_2017", "pro", ("list_id",))
    return rounded(classes, ["area"])


@query
def decode_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    landscape = F.when(F.col("code") % 3 == 0, 0).when(F.col("code") % 3 == 1, 2013).otherwise(2016)
    pixels = inputs.pixels(spark, sf_dir).select(
        legends.loss_year(F.col(LAYERS.loss)).alias("loss_year"),
        legends.intact_forest_year(landscape).alias("intact_year"),
        *[legends.intact_forest_in(landscape, y).alias(f"intact_{y}") for y in (2000, 2013, 2016)],
        "area",
    )
    keys = ["loss_year", "intact_year", "intact_2000", "intact_2013", "intact_2016"]
    return rounded(pixels.groupBy(*keys).agg(F.sum("area").alias("area")), ["area"])


@query
def decode_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = F.col(LAYERS.density)
    pixels = inputs.pixels(spark, sf_dir).select(
        legends.density_class(percent).alias("density"), legends.density_above(percent).alias("above_60"), "area"
    )
    per_class = pixels.groupBy("density", "above_60").agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n"))
    return rounded(per_class, ["area"])


@query
def decode_region_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (F.col("code") % 256).cast("int")
    flags = [legends.region_flag(code, r).alias(r.lower().replace(" ", "_")) for r in legends.REGION_BITS]
    pixels = inputs.pixels(spark, sf_dir).select(*flags, "area")
    names = [r.lower().replace(" ", "_") for r in legends.REGION_BITS]
    per_flags = pixels.groupBy(*names).agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("n"))
    return rounded(per_flags, ["area"])
