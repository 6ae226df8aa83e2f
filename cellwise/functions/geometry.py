"""Planar and equal-area geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sphere of the equal-area projection and the number of Newton steps
# that bring its auxiliary angle to machine precision.
SPHERE_M = 6378137.0
NEWTON_STEPS = 12


def ring_edges(ring: Column) -> Column:
    """Directed edges of a ring as an array of (x1, y1, x2, y2), closed at the end."""
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def cross(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Twice the signed area between an edge and the origin."""
    return x1 * y2 - x2 * y1


def equal_area_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Mollweide coordinates, in metres, of a position in degrees."""
    phi = F.radians(lat)
    target = F.lit(math.pi) * F.sin(phi)

    def step(t: Column, _: Column) -> Column:
        return t - (t + F.sin(t) - target) / (F.lit(1.0) + F.cos(t))

    # At the poles the derivative vanishes and the angle is known.
    double_angle = F.when(
        F.abs(lat) < 90, F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), phi, step)
    ).otherwise(F.signum(lat) * F.lit(math.pi))
    theta = double_angle / 2
    x = F.lit(SPHERE_M * 2 * math.sqrt(2) / math.pi) * F.radians(lon) * F.cos(theta)
    y = F.lit(SPHERE_M * math.sqrt(2)) * F.sin(theta)
    return x, y
