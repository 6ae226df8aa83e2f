"""Cells are shuffled once for the zone map and once for the statistics."""

from __future__ import annotations

from cellwise.operators import zonal
from cellwise.operators.grid import Grid, at_cells, held_cells

GRID = Grid(0.0, 4.0, 1.0, 4, 4)


def _cells(spark):
    return spark.range(32).selectExpr(
        "CAST(id div 16 AS INT) AS day", "CAST(id % 16 div 4 AS INT) AS row", "CAST(id % 4 AS INT) AS col", "CAST(id AS DOUBLE) AS value"
    )


def test_held_cells_lie_as_their_join_needs_them(spark):
    runs = spark.createDataFrame([(0, 1, 2), (3, 0, 0)], "row int, first int, last int")
    met = at_cells(runs.repartition(2), held_cells(_cells(spark).repartition(3), GRID))
    plan = met._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(dealt) == 2 and all("stretch" in line for line in dealt)
    found = sorted((r["row"], r["col"]) for r in met.collect())
    assert found == [(0, 1), (0, 2), (3, 0)]


def test_large_and_small_zones_share_one_join(spark, monkeypatch):
    names: list[str] = []
    made = zonal.written

    def written(df, purpose):
        names.append(purpose)
        return made(df, purpose)

    monkeypatch.setattr(zonal, "written", written)
    zone_map = spark.range(16).selectExpr(
        "'AAA' AS iso3", "0 AS adm_level", "CAST(IF(id < 12, 0, 1) AS INT) AS zone_idx",
        "CAST(id div 4 AS INT) AS row", "CAST(id % 4 AS INT) AS col", "1L AS w",
    )
    bounds = zonal.Bounds(16, 12, False)
    stats = ("mean", "median", "count")
    found = zonal.zonal_stats(_cells(spark), zone_map, GRID, bounds, ["day"], stats, local_cells=8)
    rows = {(r["day"], r["zone_idx"]): (r["mean"], r["median"], r["count"]) for r in found.collect()}
    assert rows == {(0, 0): (5.5, 5.5, 12), (0, 1): (13.5, 13.5, 4), (1, 0): (21.5, 21.5, 12), (1, 1): (29.5, 29.5, 4)}
    assert names.count("matched") == 1
