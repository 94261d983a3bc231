from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.shapes import TINY, frame, pixels, star, to_degrees
from zonal import Analysis, Layers, coverage_cells, loss_by_year_histogram, loss_by_year_pixelwise, run_report, standard_analyses
from zonal.operators.layers import covered_values, locations_with_tiles, spatial_join
from zonal.plans import analyses as plans
from zonal.plans import jobs
from zonal.sources.tiles import read_tiles, write_tiles

L = Layers()
NAMES = [a.name for a in standard_analyses()]


@pytest.fixture(scope="module")
def world(spark):
    """Random polygons, and tiles over part of the world; one crowded place."""
    rng = random.Random(41)
    rows = [(n % 2, n, [star(rng, rng.uniform(50, 250), rng.uniform(50, 150), rng.uniform(5, 20), 8)]) for n in range(30)]
    rows += [(2, 100 + n, [star(rng, 105, 105, 4, 6)]) for n in range(40)]
    rows += [(3, -1, [star(rng, 600, 300, 15, 6)]), (3, 9, [[(650.1, 300.1), (650.2, 300.1), (650.2, 300.2)]])]
    keys = spark.range(30 * 20).select((F.col("id") % 30).cast("int").alias("key_col"), F.expr("int(id div 30)").alias("key_row"))
    keys = keys.where("pmod(hash(key_col, key_row), 9) <> 0")

    def layer(name, expr):
        return keys.select(
            "key_col", "key_row", F.lit(name).alias("layer"), F.expr(f"transform(sequence(0, 99), i -> {expr})").alias("cells")
        )

    seed = "abs(hash(key_col, key_row, i))"
    stack = [
        layer(L.loss, f"if({seed} % 7 = 0, null, {seed} % 24)"),
        layer(L.density, f"{seed} div 24 % 101"),
        layer(L.primary, f"{seed} div 31 % 2"),
        layer(L.peat, f"{seed} div 57 % 3").where("key_col <> 7"),
    ]
    tiles = stack[0].union(stack[1]).union(stack[2]).union(stack[3])
    return rows, frame(spark, rows).persist(), tiles.persist()


def as_dict(df):
    return {(r["list_id"], r["location_id"]): {n: r[n] for n in NAMES} for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for n in NAMES:
            assert a[k][n] == pytest.approx(b[k][n], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("rule", ["center", "all_touched"])
def test_pixelwise_equals_histogram(world, rule):
    _, locations, tiles = world
    a = as_dict(loss_by_year_pixelwise(locations, tiles, TINY, rule=rule))
    b = as_dict(loss_by_year_histogram(locations, tiles, TINY, rule=rule))
    close(a, b)
    assert sum(sum(m[NAMES[0]].values()) for m in a.values()) > 0


def test_crowded_segments_are_split_without_changing_the_answer(world, monkeypatch):
    _, locations, tiles = world
    plain = as_dict(loss_by_year_histogram(locations, tiles, TINY, rows_per_task=10**9))
    split = as_dict(loss_by_year_histogram(locations, tiles, TINY, rows_per_task=3))
    close(plain, split)
    # fewer keys may be hot, and a bit of the segment map stands for several segments
    monkeypatch.setattr("zonal.operators.staging.HOT_KEYS", 5)
    monkeypatch.setattr("zonal.operators.layers.MAP_BITS", 648)
    close(plain, as_dict(loss_by_year_histogram(locations, tiles, TINY, rows_per_task=3)))


def test_against_brute_force(world):
    rows, locations, tiles = world
    got = as_dict(loss_by_year_histogram(locations, tiles, TINY))
    cells = {(t["key_col"], t["key_row"], t["layer"]): t["cells"] for t in tiles.collect()}
    areas = {r["key_row"]: r["area"] for r in jobs.with_pixel_area(locations.sparkSession.range(36).select(F.col("id").cast("int").alias("key_row")), TINY).collect()}
    assert set(got) == {(a, b) for a, b, _ in rows}, "every location is reported, covered or not"
    for list_id, location_id, rings in rows:
        want = [0.0] * 32
        for r, c in pixels(rings, "center"):
            at = (c // 10, r // 10)
            i = (r % 10) * 10 + c % 10
            loss = (cells.get((*at, L.loss)) or [None] * 100)[i]
            density = (cells.get((*at, L.density)) or [None] * 100)[i]
            if loss and density is not None and density > 30:
                want[loss] += areas[r // 10]
        assert [got[(list_id, location_id)][NAMES[0]][b] for b in range(32)] == pytest.approx(want)


@pytest.mark.parametrize("job", [loss_by_year_histogram, loss_by_year_pixelwise])
def test_areas_beside_yearly_maps(world, job):
    rows, locations, tiles = world
    layers = Layers(intact=L.primary, protected=L.peat, soy=L.primary)
    analyses = plans.extended_analyses(layers)
    got = {(r["list_id"], r["location_id"]): r for r in job(locations, tiles, TINY, layers, analyses).collect()}
    cells = {(t["key_col"], t["key_row"], t["layer"]): t["cells"] for t in tiles.collect()}
    numbers = locations.sparkSession.range(36).select(F.col("id").cast("int").alias("key_row"))
    areas = {r["key_row"]: r["area"] for r in jobs.with_pixel_area(numbers, TINY).collect()}
    assert set(got) == {(a, b) for a, b, _ in rows}
    for list_id, location_id, rings in rows:
        total = extent = habitat = 0.0
        soy = [0.0] * 32
        for r, c in pixels(rings, "center"):
            i, area = (r % 10) * 10 + c % 10, areas[r // 10]
            loss, density, primary = (
                (cells.get((c // 10, r // 10, name)) or [None] * 100)[i] for name in (L.loss, L.density, L.primary)
            )
            total += area
            extent += area if (density or 0) > 30 else 0.0
            habitat += area if (primary or 0) > 0 else 0.0
            if loss and (primary or 0) > 0:
                soy[loss] += area
        row = got[(list_id, location_id)]
        assert row["total_area"] == pytest.approx(total) and row["tree_cover_extent_total"] == pytest.approx(extent)
        assert row["natural_habitat_primary"] == pytest.approx(habitat)
        assert [row["tree_cover_loss_soy_yearly"][b] for b in range(32)] == pytest.approx(soy)


def test_area_is_conserved(world):
    _, locations, tiles = world
    everything = Analysis("total", (), yearly=True)
    by_year = loss_by_year_histogram(locations, tiles, TINY, analyses=[everything])
    got = {(r["list_id"], r["location_id"]): sum(r["total"].values()) for r in by_year.collect()}
    values = covered_values(locations, tiles, [L.loss], TINY, required=L.loss).where(F.col(L.loss).isNotNull())
    direct = jobs.with_pixel_area(values, TINY).groupBy("list_id", "location_id").agg(F.sum("area").alias("a")).collect()
    assert direct
    for r in direct:
        assert got[(r["list_id"], r["location_id"])] == pytest.approx(r["a"])


def test_stored_tiles_give_the_same_and_prune_files(world, spark, tmp_path):
    _, locations, tiles = world
    write_tiles(tiles, str(tmp_path / "t"), TINY)
    stored = read_tiles(spark, str(tmp_path / "t"))
    df = loss_by_year_histogram(locations, stored, TINY)
    close(as_dict(df), as_dict(loss_by_year_histogram(locations, tiles, TINY)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "cells" in line]
    assert scans and all("file_row" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)


def test_report_from_geojson_to_json(world, spark, tmp_path):
    rows, locations, tiles = world
    write_tiles(tiles, str(tmp_path / "t"), TINY)
    wanted = [r for r in rows if r[0] == 0][:4]
    features = [
        {
            "properties": {"list_id": a, "location_id": b},
            "geometry": {"type": "Polygon", "coordinates": [to_degrees(ring + ring[:1]) for ring in rings]},
        }
        for a, b, rings in wanted
    ]
    (tmp_path / "l.json").write_text(json.dumps({"features": features}))
    want = as_dict(loss_by_year_histogram(frame(spark, wanted), tiles, TINY))
    for method in ("histogram", "pixelwise"):
        out = str(tmp_path / method)
        run_report(
            spark, str(tmp_path / "l.json"), str(tmp_path / "t"), out, method,
            "list_id bigint, location_id bigint", files=1, grid=TINY,
        )
        lines = [json.loads(x) for p in (tmp_path / method).glob("part-*.json") for x in p.read_text().splitlines()]
        got = {(x["list_id"], x["location_id"]): {n: {int(k): v for k, v in x[n].items()} for n in NAMES} for x in lines}
        close(got, want)


def test_joins_by_key_are_spread_too(world):
    _, locations, tiles = world
    cells = coverage_cells(locations, TINY)
    columns = ["list_id", "location_id", "key_col", "key_row"]
    for make in (
        lambda n: locations_with_tiles(cells, tiles, L.peat, TINY, rows_per_task=n).select(*columns),
        lambda n: spatial_join(locations, tiles, TINY, rows_per_task=n).select(*columns, "layer"),
    ):
        plain, spread = sorted(map(tuple, make(10**9).collect())), sorted(map(tuple, make(2).collect()))
        assert plain and plain == spread


def test_plan_keeps_pixels_in_generated_code(world):
    _, locations, tiles = world
    df = loss_by_year_histogram(locations, tiles, TINY)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    unfolded = [line for line in plan.splitlines() if "Generate " in line]
    assert unfolded and all(re.search(r"\*\(\d+\) Generate", line) for line in unfolded)


def test_areas_of_interest_can_be_required(world):
    _, locations, tiles = world
    with pytest.raises(ValueError):
        loss_by_year_histogram(locations, tiles, TINY, require_aoi=True)
    one = locations.where("list_id = 3")
    assert loss_by_year_histogram(one, tiles, TINY, require_aoi=True).count() == 2


def test_nothing_covered_and_no_locations(world):
    _, locations, tiles = world
    tiny = as_dict(loss_by_year_histogram(locations.where("location_id = 9 and list_id = 3"), tiles, TINY))
    assert list(tiny) == [(3, 9)] and not any(any(m.values()) for m in tiny[(3, 9)].values())
    assert loss_by_year_histogram(locations.where("false"), tiles, TINY).count() == 0


def test_only_needed_layers_are_read(world):
    assert plans.needed_layers(standard_analyses(), L.loss) == [L.loss, L.density, L.primary, L.peat]
    assert plans.needed_layers([Analysis("x", ((L.peat, 0),))], L.loss) == [L.loss, L.peat]


def test_layer_names_are_parameters(world):
    _, locations, tiles = world
    renamed = tiles.withColumn("layer", F.concat(F.lit("my_"), "layer"))
    mine = Layers(*[f"my_{v}" for v in (L.loss, L.density, L.primary, L.peat)])
    close(as_dict(loss_by_year_histogram(locations, renamed, TINY, mine)), as_dict(loss_by_year_histogram(locations, tiles, TINY)))


@pytest.mark.parametrize("job", [loss_by_year_pixelwise, loss_by_year_histogram])
def test_tasks_of_sums_grow_with_the_locations(spark, world, job, monkeypatch):  # noqa: F811
    from zonal.operators import aggregates

    rows, locations, tiles = world
    want = as_dict(job(locations, tiles, TINY))
    monkeypatch.setattr(aggregates, "SUMS_PER_TASK", 100)
    tasks = -(-len(rows) * 32 // 100)
    made = job(locations, tiles, TINY)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert tasks > 8 and f", {tasks}), REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1
    close(as_dict(made), want)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
