"""Cells are unfolded by the columns of a band of rows, and weights are settled before that."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellwise.operators import rasterize
from cellwise.operators.coverage import coverage_runs, coverage_weights
from cellwise.operators.grid import Grid, fine_windows, held_cells
from cellwise.operators.rasterize import dissolved_pixels, owned_runs, zone_map
from cellwise.schema import ZONE_KEYS
from cellwise.session import written
from tests.scenes import whole, zone, zones

GRID = Grid(0.0, 400.0, 1.0, 400, 400)
SMALL = Grid(0.0, 90.0, 1.0, 70, 90)


def _slanted(spark):
    return zones(spark, zone("AAA", 1, 0, "P0", [(5.3, 2.1), (390.7, 30.2), (395.1, 380.6), (41.8, 391.3)]))


def _tangled(spark):
    rng = random.Random(11)
    corner = lambda: (rng.uniform(-5, 75), rng.uniform(-5, 95))
    made = [zone("AAA", level, i, f"P{level}{i}", *[[corner() for _ in range(7)] for _ in range(2)]) for level in (1, 2) for i in range(4)]
    return zones(spark, *made, zone("AAA", 2, None, "N", [(1, 1), (69, 2), (60, 80)]))


def _bytes_a_row(df, purpose):
    made = written(df.coalesce(1), purpose)
    size = sum(Path(f.removeprefix("file://")).stat().st_size for f in made.inputFiles())
    return size / made.count()


@pytest.mark.parametrize("touched", [False, True])
def test_stored_pixels_are_a_fraction_of_two_bytes(spark, touched):
    layer, spans = _slanted(spark), whole(spark, GRID, "AAA")
    assert _bytes_a_row(zone_map(layer, spans, GRID, all_touched=touched).drop("w"), "pixels") < 0.5
    assert _bytes_a_row(dissolved_pixels(layer, spans, GRID), "dissolved") < 0.5
    assert _bytes_a_row(zone_map(layer, spans, GRID, 0.75), "weights") < 0.7
    assert _bytes_a_row(coverage_weights(layer, GRID).withColumn("w", F.round("w", 6)), "shares") < 0.7


@pytest.mark.parametrize("many", [rasterize.MANY, 3])
def test_pixels_are_those_of_the_runs(spark, rows, monkeypatch, many):
    monkeypatch.setattr(rasterize, "MANY", many)
    layer, spans = _tangled(spark), whole(spark, SMALL, "AAA")
    names = [*ZONE_KEYS, "row", "col"]
    for touched in (False, True):
        runs = owned_runs(layer, fine_windows(spans, SMALL, None), touched)
        want = runs.withColumn("col", F.explode(F.sequence("lo", "hi")))
        assert rows(zone_map(layer, spans, SMALL, all_touched=touched), *names) == rows(want, *names)
    runs = coverage_runs(layer, SMALL).withColumn("col", F.explode(F.sequence("c0", "c1")))
    assert rows(coverage_weights(layer, SMALL), *names, "w") == rows(runs, *names, "w")


@pytest.mark.parametrize("resolution", [0.75, 0.4, 0.06, 1.0, 1.7])
def test_weights_of_runs_are_those_cell_by_cell(spark, rows, resolution):
    layer, spans = _tangled(spark), whole(spark, SMALL, "AAA")
    cells = spark.range(SMALL.height * SMALL.width).selectExpr(
        f"CAST(id div {SMALL.width} AS INT) AS row", f"CAST(id % {SMALL.width} AS INT) AS col"
    )
    names = [*ZONE_KEYS, "row", "col", "w"]
    made = zone_map(layer, spans, SMALL, resolution)
    by_cell = zone_map(layer, spans, SMALL, resolution, cells=held_cells(cells, SMALL))
    assert made.dtypes == by_cell.dtypes
    assert rows(made, *names) == rows(by_cell, *names) and made.count() > 1000


def test_no_pixel_is_aggregated(spark):
    plan = zone_map(_slanted(spark), whole(spark, GRID, "AAA"), GRID, 0.75)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline(rows") < plan.index("Aggregate")
