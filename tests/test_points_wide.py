"""Points in zones of any size: blocks grow with them."""

from __future__ import annotations

from cellwise.operators.rasterize import points_in_zones
from tests.scenes import box, zone, zones


def test_zones_far_larger_than_a_block(spark, rows):
    layer = zones(
        spark,
        zone("AAA", 0, 0, "W", box(0, 0, 1e9, 1e9), box(10, 10, 20, 20)),
        zone("AAA", 1, 0, "S", box(5, 5, 25, 25)),
        zone("AAA", 1, 1, "T", [(1e8, 1e8), (1e8 + 1, 1e8), (1e8, 1e8 + 1)]),
    )
    made = [(1, 15.0, 15.0), (2, 7.0, 7.0), (3, 1e8 + 0.2, 1e8 + 0.2), (4, 1e8 + 0.9, 1e8 + 0.9), (5, -1.0, 3.0), (6, 9e8, 2.0)]
    points = spark.createDataFrame(made, "id int, x double, y double")
    found = points_in_zones(points, layer, 8.0, "id")
    assert rows(found, "id", "adm_level", "zone_idx") == [
        (1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 0, 0), (3, 1, 1), (4, 0, 0), (6, 0, 0)
    ]
