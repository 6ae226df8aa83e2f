"""Zones on both sides of the limit for one task are told apart on runs, without a map of cells."""

from __future__ import annotations

from datetime import date

import pytest

from pyspark.sql import functions as F

from cellwise.operators import zonal
from cellwise.operators.grid import Grid, measure
from cellwise.operators.rasterize import zone_map, zone_runs
from cellwise.schema import STAT_COLUMNS, ZONE_KEYS
from cellwise.session import written
from tests.scenes import box, counting, dated_cells, whole, zone, zones

GRID = Grid(0.0, 6.0, 1.0, 1100, 6)


def test_large_zones_are_known_from_runs(spark, rows, monkeypatch):
    layer = zones(spark, zone("AAA", 1, 0, "P0", box(0, 0, 1050, 6)), zone("AAA", 1, 1, "P1", box(1050, 1, 1060, 5)))
    spans = whole(spark, GRID, "AAA")
    # A slice holds fewer cells than the limit, of both zones.
    cells = dated_cells(spark, {date(2020, 1, 1): counting(0, GRID.height, GRID.width)}).filter("(row + col) % 9 = 0")
    split, found = [], []
    kept = zonal.split_stats
    monkeypatch.setattr(zonal, "split_stats", lambda *a: split.append(a[0].select("zone_idx").distinct().collect()) or kept(*a))
    for mapped in (zone_map(layer, spans, GRID), zone_runs(layer, spans, GRID)):
        mapped = written(mapped, "mapped")
        bounds = zonal.Bounds.counted(mapped, measure(spans), False)
        large = zonal.zones_over(mapped, 1000)
        assert rows(large, *ZONE_KEYS) == [("AAA", 1, 0)]
        stats = zonal.zonal_stats(cells, mapped, GRID, bounds, ["valid_date"], local_cells=1000, large=large)
        stats = stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})
        found.append(rows(stats, "valid_date", *ZONE_KEYS, *STAT_COLUMNS))
    assert found[0] == found[1] and len(found[0]) == 2
    assert [[r.zone_idx for r in part] for part in split] == [[0], [0]]


def test_the_query_stores_no_map_of_cells(spark, monkeypatch):
    from workload import queries

    monkeypatch.setattr(queries.rasterize, "zone_map", lambda *a, **k: pytest.fail("a map of cells"))
    assert queries.QUERIES["zonal_stats_mixed_zones"](spark, "/root/testdata/sf0.001").count() > 0
