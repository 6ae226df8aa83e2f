"""Points against the quadtree cover, the edge join, and plain crossing counts."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from cellwise.operators.cover import FEW_EDGES, points_in_cover, zone_cover
from cellwise.operators.rasterize import points_in_zones
from tests.test_coverage import star, zone, zones_of


def inside(rings, x, y):
    found = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x:
                found = not found
    return found


def points_of(spark, points):
    return spark.createDataFrame([(i, x, y, "a", "b") for i, (x, y) in enumerate(points)], "id long, x double, y double, level string, edges string")


def found_by(df):
    return sorted((r.id, r.zone_idx) for r in df.collect())


@pytest.mark.parametrize("few", [2, 8])
def test_against_crossing_counts(spark, few):
    rng = random.Random(few)
    shapes = [[star(rng, rng.uniform(-3, 10), rng.uniform(-3, 8), rng.uniform(0.05, 4), rng.randrange(3, 40))] for _ in range(25)]
    shapes.append([[(-5, -5), (12, -5), (12, 9), (-5, 9)], [(0, 0), (0, 4), (4, 4), (4, 0)], [(1, 1), (2, 1), (2, 2), (1, 2)]])
    zones = zones_of(spark, *[zone(i, *rings) for i, rings in enumerate(shapes)])
    points = [(rng.uniform(-8, 14), rng.uniform(-8, 11)) for _ in range(1500)] + [(i / 2 + 0.013, i / 4 + 0.017) for i in range(20)]
    cover = zone_cover(zones, few)
    want = sorted((i, z) for i, (x, y) in enumerate(points) for z, rings in enumerate(shapes) if inside(rings, x, y))
    assert found_by(points_in_cover(points_of(spark, points), cover, "id")) == want
    assert found_by(points_in_zones(points_of(spark, points), zones, 2.0, "id")) == want


def test_a_long_outline_costs_a_point_no_more(spark):
    rng = random.Random(4)
    n = 4000
    circle = [((2 + math.sin(9 * a)) * math.cos(a), (2 + math.sin(9 * a)) * math.sin(a)) for a in (2 * math.pi * i / n for i in range(n))]
    cover = zone_cover(zones_of(spark, zone(0, circle)))
    sizes = cover.leaves.agg(F.max(F.size("edges")), F.count(F.when(F.size("edges") == 0, 1))).first()
    assert sizes[0] <= FEW_EDGES and sizes[1] > 100
    points = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(2000)]
    want = [(i, 0) for i, (x, y) in enumerate(points) if inside([circle], x, y)]
    assert found_by(points_in_cover(points_of(spark, points), cover, "id")) == want
    # A point is in at most one square of a zone.
    looked_up = cover.leaves.select("level", "qx", "qy").distinct().count()
    assert looked_up == cover.n_leaves


def test_many_edges_in_one_vertex(spark):
    spikes = [p for i in range(40) for p in ((0.0, 0.0), (math.cos(i / 7), math.sin(i / 7)), (math.cos((i + 0.4) / 7), math.sin((i + 0.4) / 7)))]
    cover = zone_cover(zones_of(spark, zone(0, spikes)), deepest=6)
    rng = random.Random(1)
    points = [(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(500)]
    want = [(i, 0) for i, (x, y) in enumerate(points) if inside([spikes], x, y)]
    assert found_by(points_in_cover(points_of(spark, points), cover, "id")) == want


def test_odd_points_and_empty_zones(spark):
    cover = zone_cover(zones_of(spark, zone(0, [(0, 0), (2, 0), (2, 2)]), zone(1), ("AAA", 1, 2, "x", "y", None)))
    odd = points_of(spark, [(None, 1.0), (1.5, None), (float("nan"), 1.0), (float("inf"), 1.0), (1.5, 0.3), (99.0, 0.3)])
    assert found_by(points_in_cover(odd, cover, "id")) == [(4, 0)]
    assert points_in_cover(odd.limit(0), cover, "id").count() == 0
    nothing = zone_cover(zones_of(spark, zone(1)))
    assert nothing.n_leaves == 0 and points_in_cover(odd, nothing, "id").count() == 0
