from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.shapes import TINY, frame, pixels, star
from zonal.operators import coverage as cov

RULES = ["center", "all_touched"]


def covered(df, rule="center"):
    out: dict[tuple[int, int], list] = {}
    for row in cov.coverage_pixels(df, TINY, rule).collect():
        at = (row["key_row"] * TINY.block + row["r"], row["key_col"] * TINY.block + row["c"])
        out.setdefault((row["list_id"], row["location_id"]), []).append(at)
    return out


def random_rows(seed: int, count: int):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        cx, cy, radius = rng.uniform(60, 600), rng.uniform(60, 300), rng.uniform(4, 25)
        shell = star(rng, cx, cy, radius, 9)
        rings = [shell]
        if n % 2:
            # a hole well inside: the star reaches 0.4 of its radius everywhere it turns less than half around
            hole = [(cx + dx * 0.06 * radius, cy + dy * 0.06 * radius) for dx, dy in [(-1, -1.1), (1.2, -1), (1, 1), (-1, 1.3)]]
            if len(pixels([shell], "center")) > 20:
                rings.append(hole)
        # orientation must not matter
        rings = [r if rng.random() < 0.5 else r[::-1] for r in rings]
        rows.append((n % 3, n, rings))
    return rows


@pytest.mark.parametrize("rule", RULES)
def test_matches_brute_force(spark, rule):
    rows = [(a, b, rings) for a, b, rings in random_rows(11, 40) if len(rings) == 1 or hole_inside(rings)]
    got = covered(frame(spark, rows), rule)
    for list_id, location_id, rings in rows:
        expected = pixels(rings, rule)
        found = got.get((list_id, location_id), [])
        assert len(found) == len(set(found)), "pixels must not repeat"
        assert set(found) == expected


def hole_inside(rings):
    from tests.shapes import crosses_box, edges, inside

    shell, hole = rings
    if not all(inside(x, y, [shell]) for x, y in hole):
        return False
    xs, ys = [p[0] for p in hole], [p[1] for p in hole]
    return not any(crosses_box(a, b, min(xs), min(ys), max(xs), max(ys)) for a, b in edges(shell))


@pytest.mark.parametrize("rule", RULES)
def test_union_of_overlapping_parts_and_copies(spark, rule):
    rng = random.Random(5)
    parts = [[star(rng, 300 + 6 * i, 150 + 4 * i, 14, 7)] for i in range(4)]
    rows = [(1, 7, p) for p in parts] + [(1, 7, parts[0])] * 3
    expected = set().union(*[pixels(p, rule) for p in parts])
    found = covered(frame(spark, rows), rule)[(1, 7)]
    assert sorted(found) == sorted(expected)


def test_many_copies_collapse_before_the_shuffle(spark):
    rows = frame(spark, [(1, 1, [[(100.2, 50.3), (130.4, 50.3), (130.4, 80.7), (100.2, 80.7)]])])
    copies = rows.crossJoin(spark.range(2000)).drop("id")
    assert sorted(covered(copies)[(1, 1)]) == sorted(covered(rows)[(1, 1)])
    edges = cov.spread_edges(cov.polygon_edges(copies, TINY.x_to_px, TINY.y_to_px))
    assert edges.count() == cov.spread_edges(cov.polygon_edges(rows, TINY.x_to_px, TINY.y_to_px)).count()


def test_neighbours_share_no_pixel_and_leave_no_gap(spark):
    a = [(100.0, 50.0), (137.3, 61.9), (120.1, 90.4)]
    b = [(137.3, 61.9), (150.6, 95.2), (120.1, 90.4)]
    got = covered(frame(spark, [(1, 1, [a]), (1, 2, [b[::-1]]), (1, 3, [[a[0], a[1], b[1], a[2]]])]))
    assert not set(got[(1, 1)]) & set(got[(1, 2)])
    assert set(got[(1, 1)]) | set(got[(1, 2)]) == set(got[(1, 3)])


def test_vertices_on_pixel_centres(spark):
    square = [(10.5, 10.5), (14.5, 10.5), (14.5, 13.5), (10.5, 13.5)]
    got = covered(frame(spark, [(1, 1, [square])]))[(1, 1)]
    assert sorted(got) == [(r, c) for r in range(10, 13) for c in range(10, 14)]


def test_clipped_to_the_world(spark):
    beyond = [(-7.3, -4.2), (12.4, -4.2), (12.4, 6.6), (-7.3, 6.6)]
    far_east = [(710.2, 350.1), (735.0, 350.1), (735.0, 372.0), (710.2, 372.0)]
    got = covered(frame(spark, [(1, 1, [beyond]), (1, 2, [far_east])]))
    assert set(got[(1, 1)]) == {(r, c) for r in range(0, 7) for c in range(0, 12)}
    assert set(got[(1, 2)]) == {(r, c) for r in range(350, 360) for c in range(710, 720)}


def test_tall_polygon_spans_bands(spark):
    tall = [(300.2, 3.3), (303.6, 3.3), (303.6, 356.8), (300.2, 356.8)]
    assert set(covered(frame(spark, [(1, 1, [tall])]))[(1, 1)]) == pixels([tall], "center")


@pytest.mark.parametrize("rule", RULES)
def test_crossing_rings_are_filled_by_parity(spark, rule):
    rng = random.Random(71)
    bow = [(100.2, 50.3), (120.4, 50.3), (100.2, 70.7), (120.4, 70.7)]
    lopsided = [(200.2, 50.3), (220.4, 54.1), (201.3, 90.7), (230.4, 81.7)]
    tangles = [[(rng.uniform(300, 330), rng.uniform(100, 130)) for _ in range(7)] for _ in range(6)]
    rows = [(1, n, [ring]) for n, ring in enumerate([bow, lopsided, *tangles])]
    got = covered(frame(spark, rows), rule)
    for list_id, location_id, rings in rows:
        assert sorted(got[(list_id, location_id)]) == sorted(pixels(rings, rule))


def test_coverage_needs_four_exchanges_and_no_more(spark):
    df = cov.coverage_cells(frame(spark, random_rows(23, 12)), TINY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4


def test_unclosed_and_closed_rings_agree(spark):
    ring = star(random.Random(3), 200, 100, 12, 8)
    got = covered(frame(spark, [(1, 1, [ring]), (1, 2, [ring + ring[:1]])]))
    assert sorted(got[(1, 1)]) == sorted(got[(1, 2)])


def test_cells_masks_and_counts(spark):
    df = frame(spark, random_rows(23, 12))
    want = covered(df)
    cells = cov.coverage_cells(df, TINY)
    for row in cells.withColumn("mask", cov.dense_mask(F.col("runs"), TINY.cells)).collect():
        at = {
            (row["key_row"] * 10 + i // 10, row["key_col"] * 10 + i % 10) for i, m in enumerate(row["mask"]) if m is not None
        }
        assert len(row["mask"]) == TINY.cells and len(at) == row["n_pixels"]
        assert at <= set(want[(row["list_id"], row["location_id"])])
        assert all(b["i0"] // 10 == (b["i1"] - 1) // 10 for b in row["runs"]), "a run stays in one row"
    totals = {r["list_id"]: r["n"] for r in cov.covered_pixels(df, TINY, ["list_id"]).collect()}
    assert totals == {i: sum(len(v) for k, v in want.items() if k[0] == i) for i in totals}


def test_segment_cover(spark):
    rows = [r for r in random_rows(29, 12) if len(r[2]) == 1]
    got: dict = {}
    for row in cov.segment_cover(frame(spark, rows), TINY).collect():
        got.setdefault(row["location_id"], []).append((row["key_row"], row["key_col"]))
    for _, location_id, rings in rows:
        assert sorted(got[location_id]) == sorted(pixels(rings, "all_touched", size=10))


@pytest.mark.parametrize("value", ["runs", "mask"])
def test_cell_map_splits_crowded_segments(spark, value):
    square = [[(100.3, 50.3), (115.2, 50.3), (115.2, 58.7), (100.3, 58.7)]]
    df = frame(spark, [(1, n, square) for n in range(40)])
    cells = cov.coverage_cells(df, TINY)
    maps = cov.cell_map(cells, TINY, value, max_entries=5)
    sizes = [r["n"] for r in maps.select(F.size("geom_cells").alias("n")).collect()]
    assert sum(sizes) == 80 and max(sizes) < 40
    assert cov.explode_cell_map(maps, value).select("location_id", "key_col").distinct().count() == 80


def test_bad_rule(spark):
    with pytest.raises(ValueError):
        cov.coverage_spans(frame(spark, []), TINY, rule="nearest")


@pytest.mark.parametrize("rule", RULES)
def test_tasks_grow_with_the_pixel_rows(spark, rule, monkeypatch):
    from zonal.operators import two_level

    monkeypatch.setattr(cov, "ROWS_PER_TASK", 16)
    monkeypatch.setattr(two_level, "ROWS_PER_TASK", 16)
    rows = random_rows(29, 24)
    df = frame(spark, rows)
    tasks = -(-cov.edge_rows(cov.polygon_edges(df, TINY.x_to_px, TINY.y_to_px), TINY.height) // 16)
    assert tasks > 50
    for made in (cov.coverage_cells(df, TINY, rule), two_level.two_level_cells(df, TINY, rule)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        # parts come together by the session's number, all that grows with pixel rows by the other
        assert set(re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan)) <= {"8", str(tasks)}
        assert plan.count(f", {tasks}), REPARTITION_BY_NUM") >= 3
    got = covered(df, rule)
    for list_id, location_id, rings in rows:
        assert sorted(got.get((list_id, location_id), [])) == sorted(pixels(rings, rule))


@pytest.mark.parametrize("value", ["runs", "mask"])
def test_tasks_of_cell_maps_grow_with_the_runs(spark, value, monkeypatch):
    cells = cov.coverage_cells(frame(spark, random_rows(31, 24)), TINY)
    want = {tuple(r[:4]): r["runs"] for r in cells.select(*cov.LOC, *cov.KEY, "runs").collect()}
    monkeypatch.setattr(cov, "RUNS_PER_TASK", 16)
    tasks = -(-sum(map(len, want.values())) // 16)
    assert tasks > 8
    made = cov.cell_map(cells, TINY, value)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks}), REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1
    got = cov.explode_cell_map(made, value).select(*cov.LOC, *cov.KEY, value).collect()
    assert len(got) == len(want)
    for row in got:
        runs = want[tuple(row[:4])]
        covered = sorted(i for run in runs for i in range(run["i0"], run["i1"]))
        assert row[value] == runs if value == "runs" else [i for i, m in enumerate(row[value]) if m] == covered


def test_pixel_rows_are_counted_where_they_were_made(spark):
    from suite.queries import QUERIES

    plan = QUERIES["coverage_pixels"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4
