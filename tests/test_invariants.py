"""Different ways to the same result agree."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cellwise.operators import zonal
from cellwise.operators.areas import areas_km2, planar_areas
from cellwise.operators.grid import Grid, country_windows, fine_windows, measure, prepared
from cellwise.operators.rasterize import points_in_zones, zone_map, zone_pixels
from cellwise.operators.zonal import Bounds, split_median, split_stats, zonal_stats
from cellwise.schema import STAT_COLUMNS, ZONE_KEYS
from tests.scenes import box, zone, zones

GRID = Grid(0.0, 20.0, 1.0, 30, 20)


@pytest.fixture(scope="module")
def layer(spark):
    """Random overlapping polygons over two countries, one of them with a hole."""
    rng = random.Random(7)
    made = [
        zone("AAA", 0, 0, "A", box(0.3, 0.4, 17.6, 19.7)),
        zone("BBB", 0, 0, "B", box(12.2, 2.1, 29.8, 15.3)),
    ]
    for i in range(12):
        cx, cy = rng.uniform(2, 28), rng.uniform(2, 18)
        ring = [
            (cx + rng.uniform(-4, 4), cy + rng.uniform(-4, 4)) for _ in range(rng.randint(3, 9))
        ]
        made.append(zone("AAA" if i % 2 else "BBB", 1, i // 2, f"Z{i}", ring))
    outer, hole = box(1.1, 1.2, 15.7, 15.8), list(reversed(box(4.3, 4.4, 9.6, 9.7)))
    made.append(zone("AAA", 1, 9, "HOLED", outer, hole))
    return zones(spark, *made)


@pytest.fixture(scope="module")
def spans(layer):
    return country_windows(layer, GRID)


@pytest.fixture(scope="module")
def cells(spark):
    rng = random.Random(11)
    made = [
        (date(2020, 1, 1 + d), r, c, float(rng.choice([1, 2, 3, 5, 8, 13])) if rng.random() > 0.15 else float("nan"))
        for d in range(3)
        for r in range(GRID.height)
        for c in range(GRID.width)
    ]
    return spark.createDataFrame(made, "valid_date date, row int, col int, value double")


def test_scanline_equals_parity(layer, spans, rows):
    centres = fine_windows(spans, GRID, None).select(
        "iso3",
        F.explode(F.sequence("r_lo", "r_hi")).alias("row"),
        "c_lo",
        "c_hi",
    ).select("iso3", "row", F.explode(F.sequence("c_lo", "c_hi")).alias("col"))
    points = centres.select(
        F.col("iso3").alias("home"), "row", "col", GRID.x().alias("x"), GRID.y().alias("y")
    )
    by_parity = points_in_zones(points, layer, 3.0, "home", "row", "col").filter("home = iso3")
    by_scanline = zone_pixels(layer, fine_windows(spans, GRID, None)).select(
        *ZONE_KEYS, "row", (F.col("c_lo") + F.col("fcol")).alias("col")
    )
    names = [*ZONE_KEYS, "row", "col"]
    assert rows(by_scanline, *names) == rows(by_parity, *names)


@pytest.mark.parametrize("resolution", [0.5, 0.4, 0.7, 0.05])
def test_weights_equal_the_upsampled_raster(layer, spans, cells, rows, resolution):
    mapped = zone_map(layer, spans, GRID, resolution)
    sizes = measure(spans)
    found = zonal_stats(cells, mapped, GRID, Bounds.of(sizes, 2, 2.0), ["valid_date"])
    fine = prepared(cells, spans, sizes, GRID, resolution, ["iso3"])
    pixels = (
        zone_pixels(layer, fine_windows(spans, GRID, resolution))
        .groupBy("iso3", "adm_level", F.col("frow").alias("row"), F.col("fcol").alias("col"))
        .agg(F.max("zone_idx").alias("zone_idx"))
    )
    value = F.nanvl("value", F.lit(None).cast("double"))
    made = (
        fine.join(pixels, ["iso3", "row", "col"])
        .filter(value.isNotNull())
        .groupBy("valid_date", *ZONE_KEYS)
        .agg(
            F.round(F.avg("value"), 9).alias("mean"),
            F.median("value").alias("median"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count("value").alias("count"),
            F.sum("value").alias("sum"),
            F.round(F.stddev_pop("value"), 9).alias("std"),
        )
    )
    trimmed = found.withColumns({c: F.round(c, 9) for c in ("mean", "std")})
    names = ["valid_date", *ZONE_KEYS, *STAT_COLUMNS]
    assert rows(trimmed, *names) == rows(made, *names)


def test_weights_add_up_to_pixels(layer, spans):
    weights = zone_map(layer, spans, GRID, 0.4).agg(F.sum("w")).first()[0]
    pixels = (
        zone_pixels(layer, fine_windows(spans, GRID, 0.4))
        .select("iso3", "adm_level", "frow", "fcol")
        .distinct()
        .count()
    )
    assert weights == pixels


@pytest.mark.parametrize("resolution", [None, 0.9, 0.4, 0.05])
def test_bounds_hold(layer, spans, resolution):
    mapped = zone_map(layer, spans, GRID, resolution)
    sizes = measure(spans)
    levels = layer.select("adm_level").distinct().count()
    true = Bounds.counted(mapped, sizes, resolution is not None)
    assert Bounds.of(sizes, levels, resolution and GRID.res / resolution).map_rows >= true.map_rows


def test_large_zone_plan_equals_local_plan(layer, spans, cells, rows):
    mapped = zone_map(layer, spans, GRID, 0.4)
    bounds = Bounds.of(measure(spans), 2, 2.0)
    stats = [*STAT_COLUMNS, "unique"]

    def compute(limit=zonal.LOCAL_CELLS):
        found = zonal_stats(cells, mapped, GRID, bounds, ["valid_date"], stats, limit)
        return rows(
            found.withColumns({c: F.round(c, 9) for c in ("mean", "std")}),
            "valid_date", *ZONE_KEYS, *stats,
        )

    local = compute()
    for limit in (0, 60):
        large = zonal._large_zones(mapped, limit).count()
        assert large == mapped.select(*ZONE_KEYS).distinct().count() if limit == 0 else 0 < large < 8
        assert compute(limit) == local


@pytest.mark.parametrize("shape", ["spread", "outliers", "one_value", "two_values"])
def test_split_median_is_exact(spark, shape):
    rng = random.Random(3)
    draw = {
        "spread": lambda: rng.gauss(0, 1),
        "outliers": lambda: rng.choice([rng.random(), 1e300, -1e300, 1e-300]),
        "one_value": lambda: 4.0,
        "two_values": lambda: rng.choice([1.0, 2.0]),
    }[shape]
    made = [(rng.randint(0, 3) if rng.random() > 0.5 else 0, draw(), rng.randint(1, 9)) for _ in range(5000)]
    raw = spark.createDataFrame(made, "g int, v double, w bigint")
    values = raw.groupBy("g", "v").agg(F.sum("w").alias("n"))
    ours = {r.g: r["median"] for r in split_median(values, ["g"], splits=16).collect()}
    theirs = {
        r.g: r.m for r in raw.groupBy("g").agg(F.percentile("v", 0.5, F.col("w")).alias("m")).collect()
    }
    assert ours == theirs


def test_equal_values_have_no_deviation(spark):
    made = [("g", 0.1, w) for w in range(1, 200)]
    df = spark.createDataFrame(made, "g string, v double, w bigint")
    row = split_stats(df, ["g"], ["mean", "std", "median", "count"]).first()
    assert (row["mean"], row["median"], row["count"]) == (0.1, 0.1, 19900)
    assert row["std"] < 1e-15
    row = zonal._by_rank(df, ["g"], ["mean", "std", "median", "count"]).first()
    assert (row["mean"], row["median"], row["count"]) == (0.1, 0.1, 19900)
    assert row["std"] < 1e-15


def test_broadcast_and_shuffled_joins_agree(spark, layer, spans, cells, rows):
    mapped = zone_map(layer, spans, GRID, 0.5)
    bounds = Bounds.of(measure(spans), 2, 2.0)

    def compute():
        found = zonal_stats(cells, mapped, GRID, bounds, ["valid_date"], ("sum", "count", "max"))
        return found, rows(found, "valid_date", *ZONE_KEYS, "sum", "count", "max")

    plan, sent = compute()
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().toString()
    for limit in ("100", "1"):
        spark.conf.set("spark.cellwise.broadcastRows", limit)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert compute()[1] == sent
        finally:
            spark.conf.unset("spark.cellwise.broadcastRows")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_areas(spark):
    """A one-degree box at the equator, and a hole that halves its area."""
    outer = box(0.0, 0.0, 2.0, 1.0)
    hole = list(reversed(box(0.0, 0.0, 1.0, 1.0)))
    layer = zones(spark, zone("AAA", 0, 0, "X", outer), zone("AAA", 1, 0, "Y", outer, hole))
    flat = {r.adm_level: r.area for r in planar_areas(layer).collect()}
    assert flat == {0: 2.0, 1: 1.0}
    curved = {r.adm_level: r.area for r in areas_km2(layer).collect()}
    assert curved[0] == pytest.approx(2 * 12391, rel=2e-3)
    assert curved[1] == pytest.approx(curved[0] / 2, rel=1e-4)
    world = areas_km2(zones(spark, zone("AAA", 0, 0, "W", [(-180 + i, -90) for i in range(361)] + [(180 - i, 90) for i in range(361)])))
    assert world.first().area is not None


def test_rasterising_takes_one_shuffle(layer, spans):
    """Crossings are exchanged once; pairing, ownership and weights reuse that partitioning."""
    plan = zone_map(layer, spans, GRID, 0.4)._jdf.queryExecution().executedPlan().toString()
    by_row = [line for line in plan.splitlines() if "Exchange hashpartitioning(iso3" in line and "row" in line]
    assert len(by_row) == 1


def test_statistics_take_one_shuffle_and_one_sort(layer, spans, cells):
    mapped = zone_map(layer, spans, GRID, 0.4)
    bounds = Bounds.of(measure(spans), 2, 2.0)
    found = zonal_stats(cells, mapped, GRID, bounds, ["valid_date"])
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin [cell" in line)
    above = [line.strip(" :+-") for line in lines[:join]]
    assert sum(line.startswith("Exchange") for line in above) == 1
    assert sum(line.startswith("Sort [") for line in above) == 1


def test_merging_statistics_are_reduced_before_the_shuffle(layer, spans, cells):
    mapped = zone_map(layer, spans, GRID, 0.4)
    bounds = Bounds.of(measure(spans), 2, 2.0)
    found = zonal_stats(cells, mapped, GRID, bounds, ["valid_date"], ("mean", "max", "count"))
    plan = found._jdf.queryExecution().executedPlan().toString().split("BroadcastHashJoin [cell")[0]
    assert "partial_max" in plan.split("Exchange hashpartitioning")[1]
    assert "Window" not in plan


def test_wide_rows_are_not_broadcast(spark):
    """The bound of a broadcast is in bytes, not in rows."""
    from cellwise.session import BROADCAST_BYTES, HEAP_SHARE, ROW_BYTES, broadcast_rows, small

    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert broadcast_rows(spark) * ROW_BYTES <= min(BROADCAST_BYTES, heap // HEAP_SHARE)
    table = spark.range(10)
    hints = lambda df: df._jdf.queryExecution().logical().toString()
    rows = broadcast_rows(spark)
    assert "Hint broadcast" in hints(small(table, rows))
    assert "Hint shuffle_hash" in hints(small(table, rows, 2 * ROW_BYTES))
    assert "Hint" not in hints(small(table, 1000 * rows, 10 * ROW_BYTES))
