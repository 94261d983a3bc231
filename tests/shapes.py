"""Brute-force geometry for the tests: one pixel at a time, in plain Python."""

from __future__ import annotations

import math
import random

from zonal import Grid

# 2 pixels per degree: coordinates in pixels convert to degrees without rounding.
TINY = Grid(px_per_deg=2, file_deg=10, block=10)


def star(rng: random.Random, cx: float, cy: float, radius: float, corners: int) -> list[tuple[float, float]]:
    """A simple (not self-crossing) polygon around a centre, in pixel units."""
    # one vertex per sector: no gap reaches half a turn, so no edge passes the centre's other side
    angles = [2 * math.pi * (i + rng.uniform(0, 0.9)) / corners for i in range(corners)]
    corners_at = [(a, radius * rng.uniform(0.4, 1.0)) for a in angles]
    return [(cx + reach * math.cos(a), cy + reach * math.sin(a)) for a, reach in corners_at]


def to_degrees(ring: list[tuple[float, float]], grid: Grid = TINY) -> list[tuple[float, float]]:
    return [(x / grid.px_per_deg - 180.0, 90.0 - y / grid.px_per_deg) for x, y in ring]


def frame(spark, rows, grid: Grid = TINY):
    """rows: (list_id, location_id, rings in pixel units)."""
    data = [(a, b, [to_degrees(r, grid) for r in rings]) for a, b, rings in rows]
    return spark.createDataFrame(
        data, "list_id bigint, location_id bigint, rings array<array<struct<x:double,y:double>>>"
    )


def edges(ring):
    return [(ring[i], ring[(i + 1) % len(ring)]) for i in range(len(ring))]


def inside(x: float, y: float, rings) -> bool:
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in edges(ring):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def crosses_box(a, b, x0: float, y0: float, x1: float, y1: float) -> bool:
    """Whether a segment shares a point with a box, by clipping it to the box."""
    low, high = 0.0, 1.0
    for start, delta, lo, hi in ((a[0], b[0] - a[0], x0, x1), (a[1], b[1] - a[1], y0, y1)):
        if delta == 0:
            if not lo <= start <= hi:
                return False
            continue
        t0, t1 = sorted(((lo - start) / delta, (hi - start) / delta))
        low, high = max(low, t0), min(high, t1)
    return low <= high


def pixels(rings, rule: str, size: int = 1) -> set[tuple[int, int]]:
    """(row, column) of covered cells of `size` pixels."""
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    out = set()
    for row in range(math.floor(min(ys) / size) - 1, math.ceil(max(ys) / size) + 1):
        for column in range(math.floor(min(xs) / size) - 1, math.ceil(max(xs) / size) + 1):
            hit = inside((column + 0.5) * size, (row + 0.5) * size, rings)
            if not hit and rule == "all_touched":
                box = (column * size, row * size, (column + 1) * size, (row + 1) * size)
                hit = any(crosses_box(a, b, *box) for ring in rings for a, b in edges(ring))
            if hit:
                out.add((row, column))
    return out
