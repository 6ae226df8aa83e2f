"""Work by runs: zones of a thousand million pixels, of which few cells hold a value."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellwise.operators.coverage import coverage_weights
from cellwise.operators.grid import Grid, fine_windows, held_cells
from cellwise.operators.rasterize import owned_runs, zone_counts, zone_map
from cellwise.schema import ZONE_KEYS
from tests.scenes import LEFT, RIGHT, TOP, box, whole, zone, zones

WIDE = Grid(0.0, 10.0, 1.0, 100_000_000, 10)
SMALL = Grid(0.0, 24.0, 1.0, 24, 24)
NAMES = [*ZONE_KEYS, "row", "col", "w"]


@pytest.fixture(scope="module")
def broad(spark):
    return zones(
        spark,
        zone("AAA", 0, 0, "L", box(0, 0, 60_000_000, 10)),
        zone("AAA", 0, 1, "R", box(40_000_000, 0, 90_000_000, 10)),
    )


@pytest.fixture(scope="module")
def few(spark):
    made = [(1, 5), (1, 39_999_999), (2, 40_000_000), (9, 89_999_999), (9, 90_000_000)]
    return spark.createDataFrame(made, "row int, col int")


@pytest.fixture(scope="module")
def tangled(spark):
    """Zones that overlap in chains and lie in each other."""
    far = lambda ring, dx, dy, by: [(x * by + dx, y * by + dy) for x, y in ring]
    made = [
        zone("AAA", 0, 0, "A", far(LEFT, 10, 10, 9), far(TOP, 12, 8, 5)),
        zone("AAA", 0, 1, "B", box(2, 3, 21.7, 9.2)),
        zone("AAA", 0, 2, "C", far(RIGHT, 12, 12, 8)),
        zone("AAA", 0, 3, "D", box(5, 5, 7.6, 20), box(9, 5, 11, 20)),
        zone("AAA", 0, 4, "E", box(18, 1, 23, 23)),
        zone("AAA", 1, 0, "F", far(TOP, 9, 9, 11)),
    ]
    return zones(spark, *made)


def test_a_map_of_few_cells(spark, broad, few):
    mapped = zone_map(broad, whole(spark, WIDE, "AAA"), WIDE, cells=held_cells(few, WIDE))
    assert sorted(tuple(r) for r in mapped.select("row", "col", "zone_idx").collect()) == [(1, 5, 0), (1, 39_999_999, 0), (2, 40_000_000, 1), (9, 89_999_999, 1)]
    shares = coverage_weights(broad, WIDE, held_cells(few, WIDE))
    assert sorted(tuple(r) for r in shares.select("row", "col", "zone_idx").collect()) == [(1, 5, 0), (1, 39_999_999, 0), (2, 40_000_000, 0), (2, 40_000_000, 1), (9, 89_999_999, 1)]


def test_pixels_of_wide_zones_are_counted_on_runs(spark, broad):
    counts = zone_counts(broad, whole(spark, WIDE, "AAA"), WIDE)
    assert {r.zone_idx: (r.raw, r.fine) for r in counts.collect()} == {0: (400_000_000, 400_000_000), 1: (500_000_000, 500_000_000)}


@pytest.mark.parametrize("resolution", [None, 0.75, 0.3, 1.7])
@pytest.mark.parametrize("touched", [False, True])
def test_owners_of_overlapping_zones(spark, tangled, rows, resolution, touched):
    """Runs against the rule on pixels: the highest index has each, and each has one."""
    from cellwise.operators.rasterize import zone_pixels

    fine = fine_windows(whole(spark, SMALL, "AAA"), SMALL, resolution)
    pixels = zone_pixels(tangled, fine, touched).groupBy("iso3", "adm_level", "frow", "fcol")
    want = pixels.agg(F.max("zone_idx").alias("zone_idx"))
    got = owned_runs(tangled, fine, touched).withColumn("fcol", F.explode(F.sequence("lo", "hi")))
    names = [*ZONE_KEYS, "frow", "fcol"]
    assert rows(got, *names) == rows(want, *names)


@pytest.mark.parametrize("resolution", [None, 0.75, 0.3, 1.7])
def test_maps_of_some_cells_and_counts(spark, tangled, rows, resolution):
    spans = whole(spark, SMALL, "AAA")
    mapped = zone_map(tangled, spans, SMALL, resolution)
    some = spark.range(24 * 24).selectExpr("CAST(id div 24 AS INT) AS row", "CAST(id % 24 AS INT) AS col")
    some = some.filter("(row * 7 + col) % 3 = 0")
    part = zone_map(tangled, spans, SMALL, resolution, cells=held_cells(some.union(some), SMALL))
    assert rows(part, *NAMES) == rows(mapped.join(some, ["row", "col"]), *NAMES)
    counts = mapped.groupBy(*ZONE_KEYS).agg(F.count("w").alias("raw"), F.sum("w").alias("fine"))
    assert rows(zone_counts(tangled, spans, SMALL, resolution), *ZONE_KEYS, "raw", "fine") == rows(counts, *ZONE_KEYS, "raw", "fine")
