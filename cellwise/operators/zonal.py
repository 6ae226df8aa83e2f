"""Zonal statistics: cells joined to the zone map, grouped by slice and zone.

A slice is one raster layer: a date, or a date and a leadtime or band. A group is one slice of
one zone, so it never holds more rows than the zone has source cells. That bound is known from
the clip windows before anything runs, and it picks the plan:

* statistics that merge (no median asked for): partial aggregates, whatever the size;
* windows up to ``LOCAL_CELLS`` cells: one exchange and one sort by value;
* beyond that, zones are counted: large ones go to ``split_stats``, which spreads a group over
  tasks, and only they do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.functions.values import number
from cellwise.operators.grid import Grid, Sizes, cell_place, clip, stretch
from cellwise.operators.rasterize import run_weight
from cellwise.schema import STAT_COLUMNS, ZONE_KEYS
from cellwise.session import small, written

LOCAL_CELLS = 2_000_000
# A row of a zone map by runs, with what a hash table adds to it.
RUN_BYTES = 192
MEDIAN_SPLITS = 64
SALTS = 16

STATISTICS = (*STAT_COLUMNS, "unique")


@dataclass(frozen=True)
class Bounds:
    """Sizes: rows of the whole zone map, cells of the largest zone, even weights.

    ``counted`` takes them from a stored zone map. ``of`` bounds them before there is one: with
    upsampling, output cells of several zones may share a source cell, at most as many as a
    source cell has output cells, borders included.
    """

    map_rows: int
    zone_cells: int
    weighted: bool = True

    @classmethod
    def of(cls, sizes: Sizes, levels: int, factor: float | None = None) -> Bounds:
        """``factor``: output cells along a side of a source cell, if upsampled."""
        shared = 1 if factor is None else (math.ceil(factor) + 1) ** 2
        return cls(sizes.cells * levels * shared, sizes.largest, factor is not None)

    @classmethod
    def counted(cls, zone_map: DataFrame, sizes: Sizes, weighted: bool) -> Bounds:
        return cls(zone_map.count(), sizes.largest, weighted)


def cells_in_zones(cells: DataFrame, zone_map: DataFrame, grid: Grid, bounds: Bounds) -> DataFrame:
    """Inner join of cells and zones on the cell number; cells outside all zones drop out.

    A zone map within the broadcast bound is sent to the cells. A larger one is shuffled with
    them by cell number, a key every slice has once, so no key is hot. A map from ``zone_runs``
    meets them by stretches of a row instead; upsampled, a cell then has a row per output row.
    """
    if "stretch" in zone_map.columns:
        return _cells_in_runs(cells, zone_map, grid, bounds)
    keyed = zone_map.select(grid.cell_id().alias("cell"), *ZONE_KEYS, "w")
    located = cells.withColumn("cell", grid.cell_id())
    return located.join(small(keyed, bounds.map_rows, beyond="merge"), "cell").drop("cell")


def _cells_in_runs(cells: DataFrame, runs: DataFrame, grid: Grid, bounds: Bounds) -> DataFrame:
    row, col = cell_place(grid)
    placed = cells.withColumns({"at_row": row, "at_col": col}).withColumn("stretch", stretch("at_col"))
    keyed = small(runs.withColumnRenamed("row", "at_row"), bounds.map_rows, RUN_BYTES, beyond="merge")
    met = placed.join(keyed, ["at_row", "stretch"]).filter("at_col BETWEEN first AND last")
    # The runs' own ``w`` is the width of a window.
    weight = run_weight(F.col("at_col")) if "new_w" in runs.columns else F.lit(1).cast("long")
    return met.select(*cells.columns, *ZONE_KEYS, weight.alias("w")).filter("w > 0")


def zonal_stats(
    cells: DataFrame,
    zone_map: DataFrame,
    grid: Grid,
    bounds: Bounds,
    slice_keys: Sequence[str],
    stats: Sequence[str] = tuple(STAT_COLUMNS),
    local_cells: int = LOCAL_CELLS,
    large: DataFrame | None = None,
) -> DataFrame:
    """Statistics per slice and zone that has a cell; missing cells do not count.

    Standard deviations are over the population. Add zones without cells with ``densify``. Zones
    of more than ``local_cells`` cells are spread over tasks; the results are the same. ``large`` names
    those zones, if they are known; a map by runs has them counted by the cells of each slice else.
    """
    unknown = [s for s in stats if s not in STATISTICS]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}; choose from {list(STATISTICS)}")
    keys = [*slice_keys, *ZONE_KEYS]

    def matched(part: DataFrame) -> DataFrame:
        return (
            cells_in_zones(cells, part, grid, bounds)
            .select(*keys, number(F.col("value")).alias("v"), "w")
            .filter("v IS NOT NULL")
        )

    if "median" not in stats and not (bounds.weighted and "std" in stats):
        return matched(zone_map).groupBy(*keys).agg(*[_merged(s).alias(s) for s in stats])
    if bounds.zone_cells <= local_cells:
        return _by_rank(matched(zone_map), keys, stats)
    if large is not None:
        found, large = None, written(large, "large-zones")
    elif "stretch" in zone_map.columns:
        # Runs do not tell which cells exist, so the matched ones of each slice are counted.
        found = written(matched(zone_map), "matched")
        large = written(_large_zones(found, local_cells, *slice_keys), "large-zones")
    else:
        found = None
        large = written(_large_zones(zone_map, local_cells), "large-zones")
    n_large = large.count()
    if n_large == 0:
        return _by_rank(matched(zone_map) if found is None else found, keys, stats)
    # Cells are shuffled to the zone map once, for both kinds of zones.
    found = written(matched(zone_map), "matched") if found is None else found
    named = small(large, n_large)
    rest = found.join(named, ZONE_KEYS, "left_anti")
    split = found.join(named, ZONE_KEYS, "left_semi")
    return _by_rank(rest, keys, stats).unionByName(split_stats(split, keys, stats))


def zones_over(zone_map: DataFrame, local_cells: int) -> DataFrame:
    """Zones of more cells than ``local_cells``, whether a slice holds them or not."""
    if "stretch" not in zone_map.columns:
        return _large_zones(zone_map, local_cells)
    if "new_w" in zone_map.columns:
        raise ValueError("upsampled, runs of output rows share source cells; take a map of cells")
    cells = F.sum(F.expr("CAST(last - first + 1 AS BIGINT)"))
    return zone_map.groupBy(*ZONE_KEYS).agg(cells.alias("n")).filter(F.col("n") > local_cells).select(*ZONE_KEYS)


def _large_zones(rows: DataFrame, local_cells: int, *slice_keys: str) -> DataFrame:
    """Zones with more rows than one task should sort: cells of the zone map, or matched cells of a slice."""
    held = rows.groupBy(*slice_keys, *ZONE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return held.filter(F.col("n") > local_cells).select(*ZONE_KEYS).distinct()


def _merged(stat: str) -> Column:
    """Statistics that partial aggregates merge."""
    v, w = F.col("v"), F.col("w")
    return {
        "mean": lambda: _within_range(F.sum(v * w) / F.sum(w)),
        "min": lambda: F.min(v),
        "max": lambda: F.max(v),
        "sum": lambda: F.sum(v * w),
        "std": lambda: F.stddev_pop(v),
        "count": lambda: F.sum(w),
        "unique": lambda: F.count_distinct(v),
    }[stat]()


def _within_range(mean: Column) -> Column:
    """Rounding must not push the mean of equal values past them."""
    return F.greatest(F.least(mean, F.max("v")), F.min("v"))


def _by_rank(matched: DataFrame, keys: list[str], stats: Sequence[str]) -> DataFrame:
    """Statistics that need the whole group, from one exchange and one sort, both of which spill.

    Groups are sorted by value. A running weight gives the middle ranks, the group's mean the
    deviations; what is left are plain sums.
    """
    v, w = F.col("v"), F.col("w")
    group = Window.partitionBy(*keys)
    running = group.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = matched.select(
        "*",
        F.sum(w).over(running).alias("upto"),
        F.sum(w).over(group).alias("total"),
        (F.sum(v * w).over(group) / F.sum(w).over(group)).alias("m"),
    )
    low = F.min(F.when(F.expr("upto >= (total + 1) div 2"), v))
    high = F.min(F.when(F.expr("upto >= (total + 2) div 2"), v))
    spread = F.sum(w * (v - F.col("m")) * (v - F.col("m")))
    special = {
        "mean": _within_range(F.first("m")),
        "median": (low + high) / 2,
        "std": F.sqrt(spread / F.sum(w)),
    }
    return ranked.groupBy(*keys).agg(
        *[(special[s] if s in special else _merged(s)).alias(s) for s in stats]
    )


def split_stats(matched: DataFrame, keys: list[str], stats: Sequence[str]) -> DataFrame:
    """The same statistics for groups of any size; no task holds a whole group.

    Cells are first reduced to one row per group and value, spread by both, and stored. Two
    rounds of partial aggregates over that table give everything but the median: the first the
    sums, ranges and cut points, the second the deviations from the mean.
    """
    values = written(
        matched.groupBy(*keys, "v").agg(F.sum("w").alias("n")), "values"
    )
    heads = values.groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.sum(F.col("v") * F.col("n")).alias("sum"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.count(F.lit(1)).alias("unique"),
        _cut_points(MEDIAN_SPLITS).alias("cuts"),
    )
    mean = F.greatest(F.least(F.col("sum") / F.col("count"), F.col("max")), F.col("min"))
    heads = written(heads.withColumn("mean", mean), "heads")
    placed = _placed(values, heads.select(*keys, "cuts", "mean"), keys)
    off = F.col("v") - F.col("mean")
    spread = placed.groupBy(*keys).agg(F.sum(F.col("n") * off * off).alias("squares"))
    result = heads.join(spread, keys).withColumn("std", F.sqrt(F.col("squares") / F.col("count")))
    if "median" in stats:
        result = result.join(_middle(placed, keys), keys)
    return result.select(*keys, *stats)


def split_median(values: DataFrame, keys: list[str], splits: int = MEDIAN_SPLITS) -> DataFrame:
    """Exact median of weighted values ``(*keys, v, n)``, distinct per group and value.

    Cut points from a quantile sketch divide each group into ``splits`` buckets of about equal
    size. Bucket totals, a short running sum per group, tell which bucket holds the middle
    ranks; only that bucket is sorted. The sketch steers the work, it does not touch the result.
    """
    cuts = values.groupBy(*keys).agg(_cut_points(splits).alias("cuts"))
    return _middle(_placed(values, cuts, keys), keys)


def _cut_points(splits: int) -> Column:
    shares = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    return F.percentile_approx("v", shares, F.lit(splits * 40))


def _placed(values: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Values with their bucket and whatever else ``heads(*keys, cuts, ...)`` says of the group.

    A group's head is sent to each of its salts, so the values of a hot group stay spread.
    """
    salted = values.withColumn("salt", F.pmod(F.hash("v"), F.lit(SALTS)))
    copies = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        salted.join(copies, [*keys, "salt"])
        .withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("v"))))
        .drop("salt", "cuts")
    )


def _middle(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Median from placed values: running bucket totals, then a sort of the middle bucket."""
    totals = placed.groupBy(*keys, "bucket").agg(F.sum("n").alias("held"))
    group = Window.partitionBy(*keys)
    ranked = (
        totals.withColumn("upto", F.sum("held").over(group.orderBy("bucket")))
        .withColumn("total", F.sum("held").over(group))
        .withColumn("low_rank", F.expr("(total + 1) div 2"))
        .withColumn("high_rank", F.expr("(total + 2) div 2"))
        .withColumn("before", F.col("upto") - F.col("held"))
        .filter("low_rank <= upto AND high_rank > before")
        .select(*keys, "bucket", "before", "low_rank", "high_rank")
    )
    inner = Window.partitionBy(*keys, "bucket").orderBy("v")
    middle = (
        placed.join(ranked, [*keys, "bucket"])
        .withColumn("last", F.col("before") + F.sum("n").over(inner))
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    held = "low_rank BETWEEN first AND last OR high_rank BETWEEN first AND last"
    return middle.filter(held).groupBy(*keys).agg(((F.min("v") + F.max("v")) / 2).alias("median"))


def present_slices(layers: DataFrame, spans: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """Every slice that exists, for every country with a window: rows for all of them are due.

    ``layers`` is any table with the slice keys; for stored tiles take the tiles themselves, as
    only their key columns are read. The country codes, at most 26^3 of them, come as one array
    and are unfolded per slice.
    """
    codes = spans.agg(F.collect_set("iso3").alias("codes")).scalar()
    slices = layers.select(*slice_keys).distinct().withColumn("codes", codes)
    return slices.select(*slice_keys, F.explode_outer("codes").alias("iso3"))


def filled_slices(
    cells: DataFrame, spans: DataFrame, sizes: Sizes, slice_keys: Sequence[str]
) -> DataFrame:
    """Slices with at least one value inside the country's window; the others give no rows."""
    valued = cells.filter(number(F.col("value")).isNotNull()).select(*slice_keys, "row", "col")
    return clip(valued, spans, sizes, ["iso3"]).select("iso3", *slice_keys).distinct()


def filled_slices_after(
    found: DataFrame,
    present: DataFrame,
    cells: DataFrame,
    spans: DataFrame,
    sizes: Sizes,
    slice_keys: Sequence[str],
) -> DataFrame:
    """The same, once statistics exist: only slices they leave open are looked at again.

    A country with a value in any zone has one in its window. What is left are slices without a
    value in any zone of a country, as a rule very few, so the cells are not read twice.
    ``found`` should be a stored table, as it is used on its own elsewhere.
    """
    pair = ["iso3", *slice_keys]
    sure = found.filter("count > 0").select(*pair).distinct()
    unsure = present.join(sure, pair, "left_anti")
    again = cells.join(unsure.select(*slice_keys).distinct(), list(slice_keys), "left_semi")
    late = filled_slices(again, spans, sizes, slice_keys).join(unsure, pair, "left_semi")
    return sure.unionByName(late)


def densify(
    stats: DataFrame,
    slices: DataFrame,
    zones: DataFrame,
    slice_keys: Sequence[str],
    n_zones: int | None = None,
) -> DataFrame:
    """One row per due slice and zone: zones without a cell get sum and count 0, else null.

    With the number of zones known, their keys are broadcast to the slices if few enough: a
    country with very many zones is then no hot key.
    """
    named = zones.select(*ZONE_KEYS, "pcode")
    spine = slices.join(named if n_zones is None else small(named, n_zones), "iso3")
    joined = spine.join(stats, [*slice_keys, *ZONE_KEYS], "left")
    zero = [c for c in ("sum", "count", "unique") if c in stats.columns]
    return joined.na.fill(0, zero)


def with_nan(stats: DataFrame) -> DataFrame:
    """Nulls of empty zones as NaN, for users who expect a float in every column."""
    floats = [c for c in ("mean", "median", "min", "max", "std") if c in stats.columns]
    return stats.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in floats})
