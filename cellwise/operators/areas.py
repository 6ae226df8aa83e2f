"""Areas of zones from their edges.

Rings carry their role in their direction, as in common polygon files: holes run against
their shell, so one signed sum over all edges of a zone subtracts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions.geometry import cross, equal_area_xy, ring_edges
from cellwise.operators.rasterize import zone_edges
from cellwise.schema import ZONE_KEYS


def planar_areas(zones: DataFrame, *keys: str) -> DataFrame:
    """Area of each zone in square units of its coordinates."""
    keys = keys or tuple(ZONE_KEYS)
    twice = cross(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return zone_edges(zones, *keys).groupBy(*keys).agg((F.abs(F.sum(twice)) / 2).alias("area"))


def areas_km2(zones: DataFrame, *keys: str) -> DataFrame:
    """Area of each zone in square kilometres, its coordinates being degrees.

    Vertices are projected once each, then paired into edges.
    """
    keys = keys or tuple(ZONE_KEYS)

    def projected(p):
        x, y = equal_area_xy(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    rings = zones.select(*keys, F.explode("rings").alias("ring")).filter(F.size("ring") >= 3)
    edges = rings.select(*keys, F.transform("ring", projected).alias("ring")).select(
        *keys, F.inline(ring_edges(F.col("ring")))
    )
    twice = cross(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return edges.groupBy(*keys).agg((F.abs(F.sum(twice)) / 2 / 1_000_000).alias("area"))
