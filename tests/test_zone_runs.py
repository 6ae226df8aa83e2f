"""Zone maps by runs: their size follows from outlines, and cells meet them without a map of cells."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cellwise.operators.grid import Grid, held_cells, measure
from cellwise.operators.rasterize import zone_map, zone_runs
from cellwise.operators.zonal import Bounds, cells_in_zones, zonal_stats
from cellwise.schema import ZONE_KEYS
from cellwise.session import written
from tests.scenes import box, counting, dated_cells, whole, zone, zones

GRID = Grid(0.0, 6.0, 1.0, 2100, 6)
DAY = date(2020, 1, 1)


def _layer(spark):
    hole = box(1030, 2, 1040, 4)
    return zones(
        spark,
        zone("AAA", 1, 0, "P0", box(0, 0, 2050, 6), hole),
        zone("AAA", 1, 1, "P1", [(1000, 1), (1060, 1), (1030, 5.5)]),
    )


def _cells(spark):
    held = dated_cells(spark, {DAY: counting(0, GRID.height, GRID.width)}).filter("(row * 7 + col) % 3 != 0")
    return held.withColumn("value", F.col("value") % 5)


@pytest.mark.parametrize("resolution", [None, 0.75])
@pytest.mark.parametrize("rows", ["0", "1000000"])
def test_cells_meet_runs_as_they_meet_the_map_of_cells(spark, resolution, rows):
    spark.conf.set("spark.cellwise.broadcastRows", rows)
    try:
        layer, spans, cells = _layer(spark), whole(spark, GRID, "AAA"), _cells(spark)
        by_cell = zone_map(layer, spans, GRID, resolution, cells=held_cells(cells, GRID))
        by_run = zone_runs(layer, spans, GRID, resolution)
        found = []
        for mapped in (written(by_cell, "by-cell"), written(by_run, "by-run")):
            bounds = Bounds.counted(mapped, measure(spans), resolution is not None)
            met = cells_in_zones(cells, mapped, GRID, bounds).groupBy(*ZONE_KEYS, "row", "col").agg(F.sum("w").alias("w"))
            # Zones of more cells than this in a slice are split over tasks, the others not.
            stats = zonal_stats(cells, mapped, GRID, bounds, ["valid_date"], ("median", "sum", "count"), 500)
            found.append([sorted(map(tuple, part.collect())) for part in (met, stats)])
        assert found[0] == found[1] and len(found[0][1]) == 2
    finally:
        spark.conf.unset("spark.cellwise.broadcastRows")


def test_the_map_by_runs_does_not_grow_with_cells(spark):
    spans = whole(spark, GRID, "AAA")
    assert zone_runs(_layer(spark), spans, GRID).count() < 60
