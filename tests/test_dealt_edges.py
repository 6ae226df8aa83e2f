"""Edges are dealt over tasks before each becomes a row per output row it crosses."""

from __future__ import annotations

from cellwise.operators.grid import Grid, fine_windows
from cellwise.operators.rasterize import owned_runs
from tests.scenes import whole

GRID = Grid(0.0, 6.0, 1.0, 2100, 6)


def test_edges_of_a_layer_in_one_file_are_dealt_over_tasks(spark):
    many = spark.range(400).selectExpr(
        "'AAA' AS iso3", "1 AS adm_level", "CAST(id AS INT) AS zone_idx",
        "array(array(named_struct('x', 5D * id, 'y', 0D), named_struct('x', 5D * id + 4, 'y', 0D),"
        " named_struct('x', 5D * id + 4, 'y', 6D))) AS rings",
    ).coalesce(1)
    plan = owned_runs(many, fine_windows(whole(spark, GRID, "AAA"), GRID, None))._jdf.queryExecution().executedPlan().toString()
    assert "x1" in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
