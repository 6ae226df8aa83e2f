"""Statistics by running sums against those cell by cell."""

from __future__ import annotations

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators import zonal
from cellwise.operators.coverage import exact_stats
from cellwise.operators.grid import Grid
from cellwise.operators.spans import STATISTICS, Layers, run_stats, zone_runs

GRID = Grid(0.0, 30.0, 1.0, 37, 30)
MAP = "iso3 string, adm_level int, zone_idx int, row int, col int, w long"
CELLS = "day date, lead int, row int, col int, value double, w string"


def mapped(spark, seed, kind="long"):
    """Zones of ragged runs on two levels, some cells in none, weights of one or two."""
    rng = random.Random(seed)
    rows = []
    for level in (1, 2):
        for row in range(GRID.height):
            zone = 0
            for col in range(GRID.width):
                if rng.random() < 0.2:
                    zone = rng.randrange(-1, 6)
                if zone >= 0:
                    w = rng.choice([1, 1, 1, 2]) if kind == "long" else rng.choice([0.25, 0.5, 1.0])
                    rows.append(("AAA" if zone % 2 else "BBB", level, zone, row, col, w))
    return spark.createDataFrame(rows, MAP.replace("w long", f"w {kind}"))


def layers(spark, seed, share=0.7):
    rng = random.Random(seed)
    rows = []
    for day in (1, 2, 3):
        for lead in (0, None):
            for row in range(-1, GRID.height + 1):
                for col in range(GRID.width):
                    if rng.random() < share:
                        value = rng.choice([None, float("nan"), 1e6 + rng.random(), 1e6 + rng.randrange(5)])
                        rows += [(date(2024, 1, day), lead, row, col, value, "x")] * rng.choice([1, 1, 1, 2])
    return spark.createDataFrame(rows, CELLS)


def table(df):
    names = sorted(df.columns)
    return {tuple(r[k] for k in ("day", "lead", "iso3", "adm_level", "zone_idx")): {c: r[c] for c in names if c in STATISTICS} for r in df.collect()}


@pytest.mark.parametrize("side, share", [(8, 0.7), (16, 0.05), (256, 0.7)])
def test_as_cell_by_cell(spark, side, share):
    zone_map, cells = mapped(spark, 3), layers(spark, 4, share)
    runs = zone_runs(zone_map)
    got = table(run_stats(cells, runs, GRID, 10_000, ["day", "lead"], side=side))
    bounds = zonal.Bounds(10_000, 10_000, True)
    inside = cells.drop("w").filter(f"row between 0 and {GRID.height - 1}")
    want = table(zonal.zonal_stats(inside, zone_map, GRID, bounds, ["day", "lead"], STATISTICS))
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, rel=1e-9, abs=1e-6)
        assert type(got[key]["count"]) is int


def test_fractional_weights(spark):
    zone_map, cells = mapped(spark, 5, "double"), layers(spark, 6)
    inside = cells.drop("w").filter(f"row between 0 and {GRID.height - 1}")
    got = table(run_stats(cells, zone_runs(zone_map), GRID, 10_000, ["day", "lead"], side=16))
    want = table(exact_stats(inside, zone_map, GRID, 10_000, ["day", "lead"], STATISTICS))
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, rel=1e-9, abs=1e-6)


def test_runs_are_the_zone_map_again(spark):
    zone_map = mapped(spark, 7)
    runs = zone_runs(zone_map)
    again = runs.select("iso3", "adm_level", "zone_idx", "row", F.explode(F.sequence("c0", "c1")).alias("col"), "w")
    assert again.exceptAll(zone_map).count() == 0 and zone_map.exceptAll(again).count() == 0
    assert runs.count() < zone_map.count() / 2


@pytest.mark.parametrize("side", [1, 2, 8, 64])
def test_every_stretch(side):
    rng = np.random.default_rng(side)
    at = np.flatnonzero(rng.random(side * side) < 0.8)
    v = rng.normal(size=len(at))
    if not len(at):
        at, v = np.array([0]), np.array([1.5])
    whole = np.full(side * side, np.nan)
    whole[at] = v
    whole = whole.reshape(side, side)
    held = Layers(at, v, side)
    for a in range(side):
        for b in range(a, side):
            r = np.arange(side)
            ends = np.full(side, a), np.full(side, b)
            found = held.of_zones(r, r, *ends, np.ones(side))
            part = whole[:, a : b + 1]
            n = (~np.isnan(part)).sum(axis=1)
            assert found["n"].tolist() == n.tolist()
            some = n > 0
            assert found["low"][some].tolist() == np.nanmin(part[some], axis=1).tolist()
            assert found["high"][some].tolist() == np.nanmax(part[some], axis=1).tolist()
            assert np.allclose(found["mean"][some], np.nanmean(part[some], axis=1))
            assert np.allclose(found["off"][some], np.nanvar(part[some], axis=1) * n[some])


def test_nothing_and_unknown(spark):
    zone_map, cells = mapped(spark, 8), layers(spark, 9)
    assert run_stats(cells.limit(0), zone_runs(zone_map), GRID, 10, ["day"]).count() == 0
    assert run_stats(cells, zone_runs(zone_map.limit(0)), GRID, 10, ["day"]).count() == 0
    with pytest.raises(ValueError):
        run_stats(cells, zone_map, GRID, 10, ["day"], ["median"])
