"""Small rasters and zones made for tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cellwise.operators.grid import Grid
from cellwise.schema import TILES, ZONES

# Polygon vertices of the published method's tests.
LEFT = [(-1, -1), (-0.5, -0.8), (0, -0.5), (-0.2, 0), (-0.8, 0.2), (-1, 0.5)]
TOP = [(-0.2, 0.2), (0.2, 0.5), (0, 1), (-0.5, 0.8)]
RIGHT = [(0.2, -1), (1, -0.8), (0.8, 0), (1, 0.5), (0.5, 0.8), (0, 0.2)]

SMALL_GRID = Grid(-4 / 3, 4 / 3, 2 / 3, 4, 4)


def zone(iso3, level, idx, pcode, *rings):
    points = [[(float(x), float(y)) for x, y in ring] for ring in rings]
    return (iso3, level, idx, pcode, f"name of {pcode}", points)


def zones(spark: SparkSession, *made) -> DataFrame:
    return spark.createDataFrame(list(made), ZONES)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def whole(spark: SparkSession, grid: Grid, *iso3s: str) -> DataFrame:
    """One window per country over the whole grid."""
    return spark.createDataFrame(
        [(c, 0, grid.height - 1, 0, grid.width - 1) for c in iso3s],
        "iso3 string, r_lo int, r_hi int, c_lo int, c_hi int",
    )


def dated_cells(spark: SparkSession, layers: dict[date, list[list[float]]]) -> DataFrame:
    made = [
        (day, r, c, None if v is None else float(v))
        for day, layer in layers.items()
        for r, line in enumerate(layer)
        for c, v in enumerate(line)
    ]
    return spark.createDataFrame(made, "valid_date date, row int, col int, value double")


def counting(first: int, height: int, width: int) -> list[list[float]]:
    return [[first + r * width + c for c in range(width)] for r in range(height)]


def tile(dataset, path, day, grid, values, leadtime=None, band=None, **changed):
    made = {
        "dataset": dataset,
        "path": path,
        "year_valid": day.year,
        "month_valid": day.month,
        "date_valid": day.day,
        "leadtime": leadtime,
        "band": band,
        "x0": grid.x0,
        "y0": grid.y0,
        "res": grid.res,
        "width": grid.width,
        "height": grid.height,
        "data": [float(v) for line in values for v in line],
    }
    return tuple({**made, **changed}[name] for name in TILES.names)
