"""Stacked tables, summaries, prefix sums and run-length tiles against the array forms, and what
their plans move and read."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.shapes import TINY, frame, star
from tests.test_coverage import random_rows
from tests.test_jobs import L, as_dict, close, world  # noqa: F401
from zonal import Grid, Layers, loss_by_year_histogram, standard_analyses
from zonal.functions import tile_algebra as ta
from zonal.operators import coverage as cov
from zonal.operators import layers as lay
from zonal.operators import run_tiles
from zonal.operators.staging import group_sizes, hot_keys, spread_join, stage
from zonal.operators.two_level import two_level_cells
from zonal.plans import analyses as plans
from zonal.plans import summaries
from zonal.plans.classes import add_class_maps, class_areas, class_maps
from zonal.sources import stacks
from zonal.sources.stacks import read_stack, write_stack
from zonal.sources.tiles import read_tiles, write_tiles

FOUR = [L.loss, L.density, L.primary, L.peat]


def nodes(df, name):
    """What the nodes of a kind take in, from the formatted plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(rf"\n(\(\d+\) {name}[^\n]*\n.*?)\n\n", text + "\n\n", re.S)


@pytest.fixture(scope="module")
def stack(world, spark, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("stack") / "s")
    write_stack(world[2], path, TINY, FOUR, buckets=4)
    return path


def test_stack_is_a_scan_of_the_columns_asked_for(world, spark, stack):  # noqa: F811
    tiles = world[2]
    keys = tiles.select("key_col", "key_row").distinct()
    want = {(r["key_col"], r["key_row"]): [r[c] for c in FOUR] for r in lay.join_layers(keys, tiles, FOUR).collect()}
    held = read_stack(spark, stack)
    assert {(r["key_col"], r["key_row"]): [r[c] for c in FOUR] for r in held.collect()} == want
    one = read_stack(spark, stack, [L.peat])
    assert one.columns == ["segment", "key_col", "key_row", L.peat]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert L.peat in plan.split("ReadSchema")[1] and L.loss not in plan.split("ReadSchema")[1] and "Exchange" not in plan
    with pytest.raises(ValueError, match="no layer"):
        read_stack(spark, stack, ["nowhere"])


def test_stack_refuses_two_tiles_of_a_layer(world, spark, tmp_path):  # noqa: F811
    tiles = world[2]
    with pytest.raises(Exception, match="two tiles of a layer"):
        write_stack(tiles.unionByName(tiles.limit(1)), str(tmp_path / "s"), TINY, FOUR, buckets=2)


@pytest.mark.parametrize("rows_per_task", [10**9, 3])
def test_report_from_a_stack_moves_no_cells(world, spark, stack, rows_per_task):  # noqa: F811
    _, locations, tiles = world
    df = loss_by_year_histogram(locations, read_stack(spark, stack), TINY, rows_per_task=rows_per_task)
    close(as_dict(df), as_dict(loss_by_year_histogram(locations, tiles, TINY)))
    if rows_per_task > 3:
        assert nodes(df, "ShuffledHashJoin")
        for kind in ("Exchange", "Sort", "BroadcastExchange"):
            assert not any(c in text for text in nodes(df, kind) for c in FOUR), kind


def test_areas_beside_maps_from_a_stack(world, spark, stack):  # noqa: F811
    _, locations, tiles = world
    layers = Layers(intact=L.primary, protected=L.peat, soy=L.primary)
    analyses = plans.extended_analyses(layers)
    names = [a.name for a in analyses]

    def rows(df):
        return {
            (r["list_id"], r["location_id"]): [round(v, 3) if isinstance(v, float) else {k: round(x, 3) for k, x in v.items()} for v in (r[n] for n in names)]
            for r in df.collect()
        }

    want = rows(loss_by_year_histogram(locations, tiles, TINY, layers, analyses))
    held = read_stack(spark, stack)
    assert rows(loss_by_year_histogram(locations, held, TINY, layers, analyses)) == want
    made = stage(summaries.tile_summaries(held, TINY, analyses, layers.loss))
    assert rows(summaries.loss_by_year_two_level(locations, held, made, TINY, layers, analyses)) == want
    made = stage(summaries.prefix_rows(held, TINY, analyses, layers.loss))
    assert rows(summaries.loss_by_year_prefix(locations, held, made, TINY, layers, analyses)) == want


@pytest.mark.parametrize("rule", cov.RULES)
def test_two_levels_are_the_coverage(spark, rule):
    """Stars with holes, tangles that reach out of the world, overlapping parts, a hole whose segments
    are whole, the whole world, a part without area."""
    rng = random.Random(9)
    rows = random_rows(77, 15)
    rows += [(5, 1000 + n, [[(rng.uniform(-30, 760), rng.uniform(-30, 390)) for _ in range(6)]]) for n in range(6)]
    rows += [(6, 1, [star(rng, 300, 150, 80, 9)]), (6, 1, [star(rng, 330, 160, 80, 9)]), (6, 1, [[(100, 100), (200, 100), (200, 200), (100, 200)]])]
    rows += [(7, 1, [[(100, 100), (200, 100), (200, 200), (100, 200)], [(120, 120), (180, 120), (180, 180), (120, 180)]])]
    rows += [(8, 1, [[(-10, -10), (730, -10), (730, 370), (-10, 370)]]), (9, 1, [[(50.0, 50.0), (150.0, 50.0), (150.0, 50.0)]])]
    df = frame(spark, rows)
    at = ["list_id", "location_id", "key_col", "key_row"]
    want = {tuple(r[c] for c in at): r for r in cov.coverage_cells(df, TINY, rule).collect()}
    got = {tuple(r[c] for c in at): r for r in two_level_cells(df, TINY, rule).collect()}
    assert got.keys() == want.keys()
    assert sum(r["whole"] for r in got.values()) > 0.5 * len(got)
    for key, row in got.items():
        assert row["n_pixels"] == want[key]["n_pixels"]
        assert row["runs"] is None if row["whole"] else row["runs"] == want[key]["runs"]
    with pytest.raises(ValueError):
        two_level_cells(df, TINY, "nearest")


def test_border_work_does_not_grow_with_the_area(spark):
    def runs(width):
        square = [(50.3, 50.3), (50.3 + width, 50.3), (50.3 + width, 50.3 + width), (50.3, 50.3 + width)]
        cells = two_level_cells(frame(spark, [(1, 1, [square])]), TINY)
        return cells.agg(F.sum(F.size("runs")).alias("n"), F.count_if("whole").alias("w")).first()

    small, large = runs(60), runs(240)
    assert large["w"] > 15 * small["w"] and large["n"] < 5 * small["n"]


def test_two_levels_read_no_cells_inside(world, spark, stack, tmp_path):  # noqa: F811
    _, locations, tiles = world
    analyses = standard_analyses()
    held = read_stack(spark, stack)
    summaries.write_summaries(held, str(tmp_path / "m"), TINY, analyses, L.loss)
    made = summaries.read_summaries(spark, str(tmp_path / "m"), analyses)
    df = summaries.loss_by_year_two_level(locations, held, made, TINY)
    close(as_dict(df), as_dict(loss_by_year_histogram(locations, tiles, TINY)))
    scans = [text for text in nodes(df, "Scan parquet") if "tree_cover_loss_total_yearly" in text]
    assert scans and not any(c in text for text in scans for c in FOUR)
    rows = summaries.loss_by_year_two_level(locations, held, made, TINY, rows_per_task=2)
    close(as_dict(rows), as_dict(df))


def test_prefix_sums_cost_two_look_ups_a_run(world, spark, stack, tmp_path):  # noqa: F811
    _, locations, tiles = world
    analyses = standard_analyses()
    held = read_stack(spark, stack)
    summaries.write_prefixes(held, str(tmp_path / "p"), TINY, analyses, L.loss)
    made = summaries.read_prefixes(spark, str(tmp_path / "p"), analyses)
    assert all(len(r[0]) == TINY.block + 1 and list(r[0]) == sorted(r[0]) for r in made.select(analyses[0].name).limit(200).collect())
    df = summaries.loss_by_year_prefix(locations, held, made, TINY)
    close(as_dict(df), as_dict(loss_by_year_histogram(locations, tiles, TINY)))
    scans = nodes(df, "Scan parquet")
    assert scans and not any(c in text for text in scans for c in FOUR)
    # ten times as long, a run meets as many rows
    key = made.groupBy("key_col", "key_row", "r").count().orderBy(F.desc("count")).first()
    runs = spark.createDataFrame(
        [(1, n, key["key_col"], key["key_row"], key["r"], 0, n) for n in (1, 10)],
        "list_id bigint, location_id bigint, key_col int, key_row int, r int, c0 int, c1 int",
    )
    met = spread_join(runs, made, group_sizes(runs, ["key_col", "key_row", "r"]), ["key_col", "key_row", "r"], ["location_id"], 10)
    assert [r["count"] for r in met.groupBy("location_id").count().collect()] == [key["count"]] * 2


def test_prefix_sums_and_summaries_stay_in_the_buckets(world, spark, stack, tmp_path):  # noqa: F811
    """Nothing is sent when they are made, and only coverage when they are asked."""
    analyses = standard_analyses()
    held, names = read_stack(spark, stack), [a.name for a in analyses]
    for made in (summaries.prefix_rows(held, TINY, analyses, L.loss), summaries.tile_summaries(held, TINY, analyses, L.loss)):
        assert not nodes(made, "Exchange") and nodes(made, "Scan parquet")
    summaries.write_prefixes(held, str(tmp_path / "p"), TINY, analyses, L.loss)
    summaries.write_summaries(held, str(tmp_path / "m"), TINY, analyses, L.loss)
    prefixes = summaries.read_prefixes(spark, str(tmp_path / "p"), analyses)
    whole = summaries.read_summaries(spark, str(tmp_path / "m"), analyses)
    runs = stage(cov.coverage_runs(world[1], TINY))
    by = ["list_id", "location_id", "key_col", "key_row"]
    found = summaries.zonal_prefix(runs, prefixes, by, names)
    assert len(nodes(found, "Exchange")) == 1, "the runs"
    assert len(nodes(summaries.whole_counts(runs.withColumn("n_pixels", F.lit(1)), whole, by, names), "Exchange")) == 2, "the rows, and their sums"
    # the same from rows without buckets, and where segments are hot
    want = sorted(map(tuple, found.collect()), key=str)
    assert want and want == sorted(map(tuple, summaries.zonal_prefix(runs, stage(prefixes.drop("segment")), by, names).collect()), key=str)
    assert want == sorted(map(tuple, summaries.zonal_prefix(runs, prefixes, by, names, rows_per_task=1).collect()), key=str)


def test_prefix_sums_of_wide_blocks_and_of_tiles_that_come_twice(spark):
    """More columns than a long has bits, the sixty-fourth among them."""
    grid, size = Grid(px_per_deg=130, file_deg=10, block=130), 130
    cell = "if(i % 5 = 0, null, cast(i * 7 % 3 as int)) as v"
    tile = spark.range(size * size).selectExpr("cast(id as int) as i").selectExpr("i", cell).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("t"))
    tile = tile.select(F.lit(1).alias("key_col"), F.lit(2).alias("key_row"), F.transform("t", lambda x: x["v"]).alias(L.loss))
    analyses = [plans.Analysis("n", ())]
    made = summaries.prefix_rows(stage(tile.unionByName(tile)), grid, analyses, L.loss)
    got = {}
    for r in made.collect():
        got.setdefault((r["r"], r["bucket"]), []).append(list(r["n"]))
    want = {}
    for i in range(size * size):
        if i % 5:
            want.setdefault((i // size, i * 7 % 3), set()).add(i % size)
    assert got == {k: [[sum(x < c for x in held) for c in range(size + 1)]] * 2 for k, held in want.items()}


def test_prefix_sums_are_made_in_passing_and_stored_by_pixel_row(spark, tmp_path):
    """No table of groups is held, a pixel row is one row of longs, and runs are answered from these.
    Batches end within pixel rows, counts take several longs, and some codes have no slot."""
    grid, size = Grid(px_per_deg=130, file_deg=10, block=130), 130
    analyses = [plans.Analysis("n", (), yearly=False), plans.Analysis("dense", ((L.density, 1),))]
    names, codes = [a.name for a in analyses], {}
    for i in range(size * 3):
        codes[i] = (None if i % 5 == 0 else 40 if i % 7 == 0 else i % 3, None if i % 11 == 0 else i % 4)
    cells = [[codes.get(i, (None, 0))[k] for i in range(size * size)] for k in (0, 1)]
    stack = stage(spark.createDataFrame([(1, 2, *cells)] * 2, f"key_col int, key_row int, {L.loss} array<int>, {L.density} array<int>"))
    made = summaries.prefix_rows(stack, grid, analyses, L.loss)
    assert not [kind for kind in ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "Sort") if nodes(made, kind)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        summaries.write_prefixes(stack, str(tmp_path / "p"), grid, analyses, L.loss)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.read.parquet(str(tmp_path / "p" / "rows")).groupBy("r").count().agg(F.max("count"), F.count("r")).first() == (2, size)
    prefixes = summaries.read_prefixes(spark, str(tmp_path / "p"), analyses)
    held = sorted(map(tuple, made.collect()), key=str)
    assert held == sorted(map(tuple, prefixes.collect()), key=str)
    rng = random.Random(5)
    ends = [(0, size), (0, 1), (129, 130), (6, 7), (7, 63), *[sorted(rng.sample(range(size + 1), 2)) for _ in range(12)]]
    asked = [(1, n, 1, 2, n % 3, c0, c1) for n, (c0, c1) in enumerate(ends)] + [(1, 99, 5, 5, 0, 0, size)]
    runs = stage(spark.createDataFrame(asked, "list_id bigint, location_id bigint, key_col int, key_row int, r int, c0 int, c1 int"))
    want = {}
    for _, n, col, _, r, c0, c1 in asked:
        for i in range(r * size + c0, r * size + c1) if col == 1 else ():
            loss, density = codes[i]
            slot = loss if loss is not None and loss < 32 else None
            sums = want.setdefault((n, slot), [0, 0])
            sums[0] += 2
            # cells without a slot are kept by the analysis that is not yearly
            sums[1] += 2 * (density is not None and density > 1)
    for asked_of in (prefixes, prefixes.where("r < 3")):
        for share in (10**9, 2):
            got = summaries.zonal_prefix(runs, asked_of, ["location_id"], names, share).collect()
            assert {(r["location_id"], r["bucket"]): [r["n"], r["dense"]] for r in got} == want
    found = summaries.zonal_prefix(runs, prefixes, ["location_id", "key_col", "key_row"], names)
    assert len(nodes(found, "Exchange")) == 1 and nodes(found, "ShuffledHashJoin") and not nodes(found, "ObjectHashAggregate")


def test_joins_with_tiles_get_tasks_by_their_cells(world, spark, monkeypatch):  # noqa: F811
    """No task of a join sorts more than its share, however few the session has."""
    _, locations, tiles = world
    cells = stage(cov.coverage_cells(locations, TINY))
    want = as_dict(loss_by_year_histogram(locations, tiles, TINY))
    rows = sorted(map(str, lay.locations_with_tiles(cells, tiles, L.peat, TINY, how="left").collect()))
    sizes = group_sizes(cells, ["key_col", "key_row"])
    assert lay.join_tasks(sizes, 4, TINY) == 0
    work = (sizes.count() * 4 + cells.count()) * TINY.cells
    monkeypatch.setattr(lay, "CELLS_PER_TASK", work // 20)
    monkeypatch.setattr("zonal.operators.staging.COUNTED_PER_TASK", max(1, cells.count() // 20))
    tasks = lay.join_tasks(sizes, 4, TINY)
    assert tasks >= 20
    made = lay.values_of(cells, tiles, FOUR, TINY)
    exchanges = nodes(made, "Exchange")
    assert len(exchanges) == 6 and all(f", {tasks})" in x for x in exchanges), "the rows, the keys and four layers"
    close(as_dict(loss_by_year_histogram(locations, tiles, TINY)), want)
    close(as_dict(loss_by_year_histogram(locations, tiles, TINY, rows_per_task=2)), want)
    assert rows == sorted(map(str, lay.locations_with_tiles(cells, tiles, L.peat, TINY, how="left").collect()))


def test_runs_agree_with_arrays_on_full_blocks(spark):
    """400 x 400 cells, of noise, of patches, empty, and one value; joined runs of nothing."""
    noise = "if(abs(hash(i)) % 7 = 0, null, cast(abs(hash(i, 3)) % 24 as int))"
    patches = "if((i div 16000) % 3 = 1, null, cast((i % 400) div 100 + i div 40000 as int))"
    rows = {"noise": noise, "patches": patches, "empty": "cast(null as int)", "one": "5"}
    n = 160_000
    tiles = spark.range(1).select(*[F.expr(f"transform(sequence(0, {n - 1}), i -> {e})").alias(c) for c, e in rows.items()])
    pairs = [("noise", "patches"), ("patches", "noise"), ("patches", "one"), ("one", "empty"), ("empty", "patches")]
    tiles = stage(tiles)
    named = [tiles.select(F.lit(k).alias("segment"), F.col(a).alias("a"), F.col(b).alias("b")) for k, (a, b) in enumerate(pairs)]
    whole = named[0]
    for one in named[1:]:
        whole = whole.unionByName(one)
    held = stage(whole.select("segment", "a", "b", run_tiles.to_runs(F.col("a")).alias("ra"), run_tiles.to_runs(F.col("b")).alias("rb")))
    back = held.select((run_tiles.to_cells(F.col("ra"), n) == F.col("a")).alias("same"), "a", "ra").collect()
    assert all(r["same"] or all(x is None for x in r["a"]) and not r["ra"] for r in back)
    runs, a, b = held.select("segment", "ra", "rb"), F.col("a"), F.col("b")
    for made, array in (
        (run_tiles.multiply(runs, ["segment"], "ra", "rb"), ta.local_multiply(a, b)),
        (run_tiles.greater(runs, ["segment"], "ra", 2), ta.local_greater(a, 2)),
        (run_tiles.mask(runs, ["segment"], "ra", "rb"), ta.mask(a, b)),
        (run_tiles.mask_by_value(runs, ["segment"], "ra", "rb", 3), ta.mask_by_value(a, b, 3)),
        (run_tiles.criterion(runs, ["segment"], "ra", "rb", 2), ta.criterion_tile(a, b, 2)),
    ):
        want = held.select("segment", run_tiles.to_runs(array).alias("want"))
        joined = want.join(run_tiles.collected(made, ["segment"], "got"), "segment", "left")
        for row in joined.collect():
            assert (row["got"] or []) == row["want"]
    most = held.select(run_tiles.largest(F.col("ra")).alias("x"), ta.tile_max(a).alias("y")).collect()
    assert all(r["x"] == r["y"] for r in most)
    few = run_tiles.merged(runs.where("segment = 2"), ["segment"], "ra", "rb").count()
    assert 0 < few < 0.01 * n
    nothing = held.select(run_tiles.to_runs(F.array().cast("array<int>")).alias("r")).first()
    assert nothing["r"] == []


@pytest.mark.parametrize("degrees", [10, 5])
def test_maps_prune_files(world, spark, tmp_path, degrees):  # noqa: F811
    """Only files with segments of the keys are listed, whatever the number of keys."""
    _, locations, tiles = world
    grid = Grid(px_per_deg=2, file_deg=degrees, block=10)
    write_tiles(tiles, str(tmp_path / "t"), grid)
    stored = read_tiles(spark, str(tmp_path / "t"))
    one = locations.where("list_id = 3")
    cells = cov.coverage_cells(one, grid)
    made = {
        "filter": (lay.area_tiles(stored, one, grid), lay.area_tiles(tiles, one, grid)),
        "join": (lay.spatial_join(one, stored, grid), lay.spatial_join(one, tiles, grid)),
        "tiles": (lay.locations_with_tiles(cells, stored, L.loss, grid), lay.locations_with_tiles(cells, tiles, L.loss, grid)),
    }
    for name, (pruned, plain) in made.items():
        columns = [c for c in ("list_id", "location_id", "key_col", "key_row", "layer") if c in plain.columns]
        assert sorted(map(tuple, pruned.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect())), name
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        # a scan of the tiles for each place that waits for the files of the map, by column and by row
        scans = [line for line in plan.splitlines() if "FileScan" in line and "/t]" in line]
        assert scans and plan.count("Subquery") >= 2 * len(scans) and "dynamicpruning" in plan, name
    held = {(r["key_col"], r["key_row"]) for r in lay.pruned_tiles(tiles, cells, grid).select("key_col", "key_row").collect()}
    assert held <= {(r["key_col"], r["key_row"]) for r in cells.collect()}, "exact where a bit is a segment"


def test_a_bit_may_stand_for_a_square(world, monkeypatch):  # noqa: F811
    _, locations, tiles = world
    keys = cov.segment_cover(locations.where("list_id < 2"), TINY)
    exact = {(r["key_col"], r["key_row"]) for r in keys.collect()}
    monkeypatch.setattr(lay, "MAP_BITS", 648)
    loose = {(r["key_col"], r["key_row"]) for r in lay.pruned_tiles(tiles, keys, TINY).select("key_col", "key_row").collect()}
    every = {(r["key_col"], r["key_row"]) for r in tiles.collect()}
    assert exact & every <= loose < every
    closed = lay.pruned_tiles(tiles, keys, TINY, exact=True)
    assert {(r["key_col"], r["key_row"]) for r in closed.select("key_col", "key_row").collect()} == exact & every


def test_only_hot_keys_are_copied(world, spark, monkeypatch):  # noqa: F811
    rows = stage(spark.range(4000).select(F.when(F.col("id") % 4 < 3, 1).otherwise(F.col("id")).cast("int").alias("k"), "id"))
    once = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.array(F.col("id")).alias("cells"))
    sizes = group_sizes(rows, ["k"])
    assert [(r["k"], r["salts"]) for r in hot_keys(sizes, ["k"], 100)] == [(1, 30)]
    df = spread_join(rows, once, sizes, ["k"], ["id"], 100)
    assert sorted(tuple(r) for r in df.select("id", "k", "cells").collect()) == sorted(
        tuple(r) for r in rows.join(once, "k").select("id", "k", "cells").collect()
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    cold = plan.split("Union")[1].split("SortMergeJoin")[1]
    assert cold.count("Exchange hashpartitioning") == 2 and "explode" not in cold.lower()
    monkeypatch.setattr("zonal.operators.staging.HOT_KEYS", 2)
    assert hot_keys(sizes, ["k"], 100)[0]["salts"] == 2, "no more copies than shares of all rows"


def test_rows_without_a_tile_can_be_kept(world):  # noqa: F811
    _, locations, tiles = world
    cells = cov.coverage_cells(locations, TINY)
    both = lay.locations_with_tiles(cells, tiles, L.peat, TINY, how="left")
    assert both.count() == cells.count()
    assert both.where(F.col(L.peat).isNotNull()).count() == lay.locations_with_tiles(cells, tiles, L.peat, TINY).count()
    with pytest.raises(ValueError):
        lay.locations_with_tiles(cells, tiles, L.peat, TINY, how="right")


def test_class_maps_hold_any_code(world):  # noqa: F811
    _, locations, tiles = world
    coded = tiles.where(F.col("layer") == L.loss).withColumn("cells", F.transform("cells", lambda x: x * 2000 + 11)).withColumn("layer", F.lit("land"))
    areas = class_areas(locations, coded, "land", TINY)
    maps = class_maps(areas)
    assert {k for r in maps.collect() for k in r["areas"]} == {x * 2000 + 11 for x in range(24)}
    per_list = {r["list_id"]: r["areas"] for r in add_class_maps(maps, ["list_id"]).collect()}
    for r in areas.groupBy("list_id", "code").agg(F.sum("area").alias("a")).collect():
        assert per_list[r["list_id"]][r["code"]] == pytest.approx(r["a"])
    pixels = lay.covered_values(locations, coded, ["land"], TINY).where("land is not null")
    assert areas.count() == pixels.select("list_id", "location_id", "land").distinct().count()


def test_run_tiles_are_merged_inside_their_rows(spark):
    rng = random.Random(31)
    tile = lambda: [rng.choice([None, 1, 1, 2, 7]) for _ in range(60)]
    rows = [(n, tile() if n % 5 else None, tile() if n % 7 else None) for n in range(40)]
    held = stage(spark.createDataFrame(rows, "segment int, a array<int>, b array<int>"))
    tiles = stage(held.select("segment", *[run_tiles.to_runs(F.col(c)).alias(c) for c in "ab"]))
    by = ["segment"]
    for made in (run_tiles.multiply(tiles, by, "a", "b"), run_tiles.greater(tiles, by, "a", 1), run_tiles.merged(tiles, by, "a", "b")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan
    cells = {}
    for r in run_tiles.multiply(tiles, by, "a", "b").collect():
        cells.setdefault(r["segment"], []).extend((i, r["v"]) for i in range(r["i0"], r["i1"]))
    for n, a, b in rows:
        want = [(i, x * y) for i, (x, y) in enumerate(zip(a or [], b or [])) if x is not None and y is not None]
        assert sorted(cells.get(n, [])) == want


def test_runs_of_doubles_and_of_nothing(spark):
    nan = float("nan")
    rows = [(1, [0.5, 0.5, None, nan, nan, -1.25]), (2, []), (3, None), (4, [None, None])]
    df = spark.createDataFrame(rows, "n int, cells array<double>")
    got = {r["n"]: r["runs"] for r in df.select("n", run_tiles.to_runs(F.col("cells"), "double").alias("runs")).collect()}
    assert [(r["i0"], r["i1"], repr(r["v"])) for r in got[1]] == [(0, 2, "0.5"), (3, 5, "nan"), (5, 6, "-1.25")]
    assert got[2] == [] and got[3] is None and got[4] == []


def test_tiles_under_coverage_are_never_broadcast(spark):
    cells = spark.createDataFrame([(1, 2, 3, 4, 7, [(0, 3), (5, 6)])], "list_id int, location_id int, key_col int, key_row int, segment int, runs array<struct<i0:int,i1:int>>")
    tiles = spark.createDataFrame([(7, [(1, 6, 9)])], "segment int, t array<struct<i0:int,i1:int,v:int>>")
    by = ["list_id", "location_id", "key_col", "key_row"]
    made = run_tiles.masked_by_coverage(cells, tiles, by, "t", ("segment",))
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["i0"], r["i1"], r["v"]) for r in made.collect()) == [(1, 3, 9), (5, 6, 9)]
    dense = spark.createDataFrame([(7, [None, 9, 9, 9, 9, 9, 4])], "segment int, t array<int>")
    assert run_tiles.masked_by_coverage(cells, dense, by, "t", ("segment",)).collect() == made.collect()


def test_what_is_written_leaves_no_shuffle_behind(spark, tmp_path):
    from zonal.operators import staging

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before = shuffles()
    numbers = spark.range(1000).select(F.col("id").alias("segment"), (F.col("id") % 7).alias("b"))
    held = stage(numbers.groupBy("b").agg(F.sum("segment").alias("s")))
    assert sorted(tuple(r) for r in held.collect()) == [(b, sum(range(b, 1000, 7))) for b in range(7)]
    until = time.time() + 10  # executors are told, and not waited for
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert shuffles() - before == set()
    stacks.write_buckets(numbers, f"{tmp_path}/b", 4, ["segment"])
    assert all(".zstd." in f for f in [*held.inputFiles(), *spark.read.parquet(f"{tmp_path}/b").inputFiles()])
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(name)
    with staging.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == own


def test_run_totals_write_no_runs(spark, monkeypatch):
    from suite import inputs, queries

    rows = [(0, 0, 0, [1, 1, None, 0], [5, 5, 7, 9]), (1, 1, 0, [None] * 4, [1, 2, 3, 4]), (2, 2, 0, None, [1, 1, 1, 1]), (3, 3, 0, [4, 4, 4, 4], None)]
    stack = spark.createDataFrame(rows, f"segment bigint, key_col int, key_row int, `{L.loss}` array<int>, `{L.density}` array<int>")
    runs = stack.select("segment", "key_col", "key_row", *[run_tiles.to_runs(F.col(c)).alias(c) for c in (L.loss, L.density)])
    monkeypatch.setattr(inputs, "run_stack", lambda spark, sf_dir: runs)
    monkeypatch.setattr(queries, "stage", lambda df: pytest.fail("runs are kept"))
    got = queries.tile_runs_mask(spark, "")
    assert sorted(map(tuple, got.collect())) == [(0, 0, 19, 3), (1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
