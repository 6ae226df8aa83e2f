"""Exact coverage shares against areas, clipping and plain definitions."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from cellwise.operators.coverage import coverage_runs, coverage_weights, exact_stats
from cellwise.operators.grid import Grid

GRID = Grid(x0=-2.0, y0=7.0, res=0.5, width=22, height=18)


def zone(idx, *rings):
    return ("AAA", 1, idx, f"P{idx}", f"zone {idx}", [[(float(x), float(y)) for x, y in ring] for ring in rings])


def zones_of(spark, *rows):
    schema = "iso3 string, adm_level int, zone_idx int, pcode string, name string, rings array<array<struct<x: double, y: double>>>"
    return spark.createDataFrame(list(rows), schema)


def clipped(ring, grid, row, col):
    """Area of a ring within a cell, cut side by side."""
    x0, y1 = grid.x0 + col * grid.res, grid.y0 - row * grid.res
    x1, y0 = x0 + grid.res, y1 - grid.res
    for axis, limit, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for a, b in zip(ring, ring[1:] + ring[:1]):
            ina, inb = keep * (a[axis] - limit) >= 0, keep * (b[axis] - limit) >= 0
            if ina != inb:
                t = (limit - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
            if inb:
                out.append(b)
        ring = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2 if ring else 0.0


def star(rng, cx, cy, reach, n=9):
    """A ring that does not cross itself: its vertices turn about the centre."""
    spokes = [(rng.uniform(0.3, 1) * reach, 2 * math.pi * i / n) for i in range(n)]
    return [(cx + r * math.cos(turn), cy + r * math.sin(turn)) for r, turn in spokes]


def shares(df):
    return {(r.zone_idx, r.row, r.col): r.w for r in df.collect()}


def test_random_polygons_against_clipping(spark):
    rng = random.Random(8)
    rings = [star(rng, rng.uniform(-3, 10), rng.uniform(-3, 8), rng.uniform(0.1, 4)) for _ in range(30)]
    rings = [ring[::-1] if i % 2 else ring for i, ring in enumerate(rings)]
    got = shares(coverage_weights(zones_of(spark, *[zone(i, r) for i, r in enumerate(rings)]), GRID))
    for i, ring in enumerate(rings):
        for row in range(GRID.height):
            for col in range(GRID.width):
                want = clipped(ring, GRID, row, col) / GRID.res**2
                assert got.get((i, row, col), 0.0) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("turned", [False, True])
def test_holes_islands_and_touching_rings(spark, turned):
    outer = [(-1, -1), (8, -1), (8, 6), (-1, 6)]
    hole = [(0.3, 0.2), (0.3, 4.9), (5.1, 4.9), (5.1, 0.2)]
    island = [(1, 1), (2.2, 1), (2.2, 2.2), (1, 2.2)]
    touching = [(8, 6), (6.5, 5.5), (7, 4)]  # a hole that meets the outer ring at a vertex
    far = [(8.4, 0), (8.9, 0), (8.9, 0.7)]
    rings = [outer, hole, island, touching, far]
    if turned:
        rings = [r[::-1] if k % 2 else r for k, r in enumerate(rings)]
    got = coverage_weights(zones_of(spark, zone(1, *rings[::-1])), GRID)
    area = lambda ring: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2
    want = area(outer) - area(hole) + area(island) - area(touching) + area(far)
    assert got.agg(F.sum("w")).first()[0] * GRID.res**2 == pytest.approx(want, rel=1e-9)
    assert got.agg(F.max("w")).first()[0] <= 1 + 1e-12


def test_edges_on_cell_borders(spark):
    got = shares(coverage_weights(zones_of(spark, zone(0, [(0, 0), (2, 0), (2, 1), (0, 1)])), GRID))
    assert got == {(0, r, c): 1.0 for r in (12, 13) for c in range(4, 8)}
    runs = coverage_runs(zones_of(spark, zone(0, [(-50, -50), (50, -50), (50, 50), (-50, 50)])), GRID).collect()
    assert sorted((r.row, r.c0, r.c1, r.w) for r in runs) == [(r, 0, GRID.width - 1, 1.0) for r in range(GRID.height)]


def test_rings_without_area_and_empty_tables(spark):
    flat = [(0, 0), (1, 1), (2, 2)]
    odd = zones_of(spark, zone(0, flat), zone(1, [(0, 0), (1, 1)]), zone(2), ("AAA", 1, 3, "x", "y", None), zone(4, [(90, 90), (91, 90), (91, 91)]))
    assert coverage_weights(odd, GRID).count() == 0
    assert coverage_weights(odd.limit(0), GRID).count() == 0


def test_statistics(spark):
    rng = random.Random(1)
    weights = [("AAA", 1, z, r, c, rng.uniform(0.05, 1)) for z in range(2) for r in range(4) for c in range(5) if rng.random() < 0.8]
    values = {(d, r, c): rng.choice([None, float("nan"), 1.0, 2.5, 2.5, 7.0]) for d in (1, 2) for r in range(4) for c in range(5)}
    cells = spark.createDataFrame([(*k, v, "x") for k, v in values.items()], "day int, row int, col int, value double, w string").drop("w")
    table = spark.createDataFrame(weights, "iso3 string, adm_level int, zone_idx int, row int, col int, w double")
    rows = exact_stats(cells, table, GRID, len(weights), ["day"], quantiles=(0.25, 0.9)).collect()
    assert len(rows) == 4
    for r in rows:
        held = [(values[r.day, row, col], w) for _, _, z, row, col, w in weights if z == r.zone_idx]
        held = sorted((v, w) for v, w in held if v is not None and not math.isnan(v))
        total = sum(w for _, w in held)
        mean = sum(v * w for v, w in held) / total

        def quantile(q):
            run, found = 0.0, None
            for v, w in held:
                run += w
                if found is None and run >= q * total * (1 - 1e-12):
                    found = v
            return found

        want = {
            "mean": mean, "sum": mean * total, "count": total, "min": held[0][0], "max": held[-1][0], "median": quantile(0.5),
            "q25": quantile(0.25), "q90": quantile(0.9), "std": math.sqrt(sum(w * (v - mean) ** 2 for v, w in held) / total),
        }
        assert {k: r[k] for k in want} == pytest.approx(want)


def test_equal_weights_are_plain_statistics(spark):
    cells = spark.createDataFrame([(0, c, float(c % 4)) for c in range(8)], "row int, col int, value double")
    table = spark.createDataFrame([("A", 1, 0, 0, c, 0.5) for c in range(8)], "iso3 string, adm_level int, zone_idx int, row int, col int, w double")
    row = exact_stats(cells, table, GRID, 8, []).first()
    assert (row["median"], row["mean"], row["count"]) == (1.5, 1.5, 4.0)


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        exact_stats(spark.range(1), spark.range(1), GRID, 1, [], ["mode"])


def test_runs_take_one_exchange(spark):
    """Pieces are dealt by line once, for the sums of cells and for those along the line."""
    runs = coverage_runs(zones_of(spark, zone(0, [(0.5, 0.5), (7.5, 0.5), (3.5, 6.5)])), GRID)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    by_row = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "row#" in x]
    assert len(by_row) == 1, plan
