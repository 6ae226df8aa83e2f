"""Zones of more pixels than an int counts."""

from __future__ import annotations

from cellwise.operators.grid import Grid
from cellwise.plans.metadata import RasterSource, pixel_counts
from cellwise.schema import RINGS


def _counts(spark, grid: Grid, resolution: float | None):
    ring = [(0.0, 0.0), (float(grid.width), 0.0), (float(grid.width), float(grid.height)), (0.0, float(grid.height))]
    rows = [("AAA", 0, 0, [[{"x": x, "y": y} for x, y in ring]])]
    zones = spark.createDataFrame(rows, f"iso3 string, adm_level int, zone_idx int, rings {RINGS.simpleString()}")
    return pixel_counts(zones, RasterSource("d", grid, resolution))


def test_counts_beyond_an_int(spark):
    found = _counts(spark, Grid(0.0, 50_000.0, 1.0, 50_000, 50_000), None).first()
    assert (found["n_intersect_raw_pixels"], found["n_upsampled_pixels"]) == (50_000**2, 50_000**2)


def test_upsampled_counts_beyond_an_int(spark):
    found = _counts(spark, Grid(0.0, 20_000.0, 1.0, 20_000, 20_000), 0.25).first()
    assert (found["n_intersect_raw_pixels"], found["n_upsampled_pixels"]) == (20_000**2, 80_000**2)


def test_small_grids_keep_ints(spark):
    found = _counts(spark, Grid(0.0, 4.0, 1.0, 8, 4), 0.5)
    kinds = dict(found.dtypes)
    assert kinds["n_intersect_raw_pixels"] == kinds["n_upsampled_pixels"] == "int"
    assert found.first()["n_upsampled_pixels"] == 128
