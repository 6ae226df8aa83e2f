"""Running sums take their runs from outlines, and read a block's runs once for all slices."""

from __future__ import annotations

from datetime import date

import pytest

from cellwise.operators import rasterize
from cellwise.operators.grid import Grid
from cellwise.operators.spans import run_stats, zone_runs
from cellwise.session import written
from tests.scenes import box, counting, dated_cells, whole, zone, zones

# Wider than a stretch of a zone map by runs, so that runs are cut and joined up again.
GRID = Grid(0.0, 6.0, 1.0, 2100, 6)


def _layer(spark):
    hole = box(1030, 2, 1040, 4)
    return zones(
        spark,
        zone("AAA", 1, 0, "P0", box(0, 0, 2050, 6), hole),
        zone("AAA", 1, 1, "P1", [(1000, 1), (1060, 1), (1030, 5.5)]),
        zone("AAA", 1, None, "P2", box(2060, 1, 2070, 3)),
    )


def test_runs_of_the_outlines_are_those_of_the_cells(spark, rows):
    layer, spans = _layer(spark), whole(spark, GRID, "AAA")
    by_run = zone_runs(rasterize.zone_runs(layer, spans, GRID))
    by_cell = zone_runs(rasterize.zone_map(layer, spans, GRID))
    names = ["iso3", "adm_level", "zone_idx", "row", "c0", "c1", "w"]
    assert by_run.select(names).dtypes == by_cell.select(names).dtypes
    assert rows(by_run, *names) == rows(by_cell, *names) and by_run.count() > 10
    with pytest.raises(ValueError):
        zone_runs(rasterize.zone_runs(layer, spans, GRID, 0.75))


def test_runs_are_not_repeated_per_slice(spark):
    layer, spans = _layer(spark), whole(spark, GRID, "AAA")
    cells = dated_cells(spark, {date(2020, 1, d): counting(d, GRID.height, GRID.width) for d in (1, 2)})
    runs = written(zone_runs(rasterize.zone_runs(layer, spans, GRID)), "runs")
    made = run_stats(cells, runs, GRID, 100, ["valid_date"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert {(r["zone_idx"], r["count"]) for r in made.select("zone_idx", "count").distinct().collect()} >= {(None, 20)}
