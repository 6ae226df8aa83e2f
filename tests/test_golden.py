"""Known results of small rasters, published with the method.

Fixed values: the layouts and expected numbers below, and the polygons of ``scenes``.
"""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cellwise.operators.grid import Grid, measure, upsample
from cellwise.operators.rasterize import zone_map
from cellwise.operators.zonal import Bounds, densify, present_slices, with_nan, zonal_stats
from cellwise.schema import required_dims
from tests.scenes import LEFT, RIGHT, SMALL_GRID, TOP, counting, dated_cells, whole, zone, zones

D1, D2 = date(2021, 1, 1), date(2021, 1, 2)


def stats_by_zone(spark, layout, n_zones, stats=("mean", "median", "max", "min", "sum", "std", "count")):
    grid = Grid(0, 3, 1, 3, 3)
    made = [("AAA", 0, z, r, c, 1) for r, line in enumerate(layout) for c, z in enumerate(line)]
    mapped = spark.createDataFrame(
        made, "iso3 string, adm_level int, zone_idx int, row int, col int, w bigint"
    )
    cells = dated_cells(spark, {D1: counting(1, 3, 3)})
    found = zonal_stats(cells, mapped, grid, Bounds(9, 9, False), ["valid_date"], stats)
    listed = zones(spark, *[zone("AAA", 0, z, f"Z{z}", LEFT) for z in range(n_zones)])
    due = present_slices(cells, whole(spark, grid, "AAA"), ["valid_date"])
    return {r.zone_idx: r for r in densify(found, due, listed, ["valid_date"]).collect()}


def test_statistics_per_zone(spark):
    found = stats_by_zone(spark, [[1, 1, 2], [1, 2, 2], [0, 0, 0]], 3)
    assert (found[0]["mean"], found[0]["median"], found[0]["count"]) == (8, 8, 3)
    assert (found[1]["max"], found[1]["sum"]) == (4, 7)
    assert found[2]["min"] == 3
    assert found[2]["std"] == pytest.approx(1.247219, abs=1e-6)


def test_zones_without_pixels_have_rows(spark):
    found = stats_by_zone(spark, [[1, 1, 2], [5, 2, 2], [0, 0, 0]], 6)
    assert len(found) == 6
    assert found[5]["median"] == 4
    assert (found[4]["count"], found[4]["sum"]) == (0, 0)
    assert found[3]["mean"] is None


def test_rasterize_centre_rule(spark, rows):
    layer = zones(
        spark,
        zone("AAA", 0, 0, "LEFT", LEFT),
        zone("AAA", 0, 1, "TOP", TOP),
        zone("AAA", 0, 2, "RIGHT", RIGHT),
    )
    mapped = zone_map(layer, whole(spark, SMALL_GRID, "AAA"), SMALL_GRID)
    assert rows(mapped, "row", "col", "zone_idx") == [(1, 2, 2), (2, 1, 0), (2, 2, 2)]


EXPECTED = {
    (D1, "LEFT"): (10, 10, 10, 10, 10, 0, 1),
    (D1, "TOP"): (None, None, None, None, 0, None, 0),
    (D1, "RIGHT"): (9, 11, 7, 9, 18, 2, 2),
    (D2, "LEFT"): (26, 26, 26, 26, 26, 0, 1),
    (D2, "TOP"): (None, None, None, None, 0, None, 0),
    (D2, "RIGHT"): (25, 27, 23, 25, 50, 2, 2),
}
FORMS = {"LEFT": LEFT, "TOP": TOP, "RIGHT": RIGHT}


@pytest.mark.parametrize("order", [("LEFT", "TOP", "RIGHT"), ("LEFT", "RIGHT", "TOP")])
@pytest.mark.parametrize("weighted", [False, True])
def test_statistics_of_two_dates(spark, order, weighted):
    layer = zones(spark, *[zone("AAA", 0, i, p, FORMS[p]) for i, p in enumerate(order)])
    cells = dated_cells(spark, {D1: counting(1, 4, 4), D2: counting(17, 4, 4)})
    spans = whole(spark, SMALL_GRID, "AAA")
    mapped = zone_map(layer, spans, SMALL_GRID)
    bounds = Bounds.of(measure(spans), 1, 2.0 if weighted else None)
    found = zonal_stats(cells, mapped, SMALL_GRID, bounds, ["valid_date"])
    full = densify(found, present_slices(cells, spans, ["valid_date"]), layer, ["valid_date"])
    names = ["mean", "max", "min", "median", "sum", "std", "count"]
    assert {
        (r.valid_date, r.pcode): tuple(r[n] for n in names) for r in full.collect()
    } == EXPECTED


def test_nan_view(spark):
    df = spark.createDataFrame([(None, 0.0)], "mean double, sum double")
    assert with_nan(df).filter(F.isnan("mean") & (F.col("sum") == 0)).count() == 1


def test_upsampling_doubles_the_raster(spark):
    grid = Grid(0, 10, 1.0, 10, 10)
    cells = dated_cells(spark, {D1: counting(0, 10, 10), D2: counting(100, 10, 10)})
    fine = upsample(cells, grid, 0.5)
    assert grid.upsampled(0.5)[:2] == (20, 20)
    assert fine.count() == 800
    r = fine.filter("row = 19 AND col = 0").orderBy("valid_date").collect()
    assert [x.value for x in r] == [90, 190]


def test_truncated_upsampling(spark, rows):
    """5 cells at 1.5 make 7; each takes the nearest source centre."""
    grid = Grid(0, 1, 1.0, 5, 1)
    cells = dated_cells(spark, {D1: [[0, 1, 2, 3, 4]]})
    fine = upsample(cells, grid, 1 / 1.5)
    assert rows(fine, "col", "value") == [(j, int((j + 0.5) * 5 / 7)) for j in range(7)]


def test_unknown_statistic(spark):
    with pytest.raises(ValueError, match="unknown statistics"):
        stats_by_zone(spark, [[0, 0, 0]] * 3, 1, ("mean", "mode"))


def test_required_dimensions(spark):
    known = {"leadtime", "band"}
    df = spark.createDataFrame([(1, 2, 3, 4)], "x int, y int, valid_date int, leadtime int")
    assert required_dims(df, known) == "leadtime"
    assert required_dims(df.drop("leadtime"), known) is None
    with pytest.raises(ValueError, match="valid_date"):
        required_dims(df.drop("valid_date"), known)
