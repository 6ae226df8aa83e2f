"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.functions.dates import issued_date
from cellwise.operators import areas, cover, coverage, grid as grids, merge, quality, rasterize, simplify, spans, topology, zonal
from cellwise.plans import jobs, metadata, runs
from cellwise.schema import RINGS, STAT_COLUMNS, TILES, ZONE_KEYS, DatasetSpec, to_schema
from cellwise.session import shared_dir, small, written
from cellwise.sources import catalog, sinks, tables, tiles as tile_source
from cellwise.streaming import updates
from workload import inputs
from workload.inputs import Scene, table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL twins.
FINE = 0.75
AS_OF = date(2001, 10, 1)
PLANS_AS_OF = date(2001, 7, 31)
CHUNK_SIZE = 6
SOME_CODES = ("AAB", "AAD", "AAX")
DEGREE_COVERAGE = ("RAX", "RCX")
TOLERANCE = 0.02
FEW_VERTICES = 20
FAR_AHEAD = date(2100, 1, 1)
STREAM_SPEC = DatasetSpec("embeddings", "tiles/t_", date(2020, 1, 1), "D")

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names or ("mean", "std") if c in df.columns})


def stats_of(
    scene: Scene,
    cells: DataFrame,
    slice_keys: list[str],
    zones: DataFrame,
    resolution: float | None = None,
    stats: tuple[str, ...] = tuple(STAT_COLUMNS),
) -> DataFrame:
    mapped, bounds = map_of(scene, zones, resolution)
    return zonal.zonal_stats(cells, mapped, scene.grid, bounds, slice_keys, stats)


def map_of(scene: Scene, zones: DataFrame, resolution: float | None = None) -> tuple[DataFrame, zonal.Bounds]:
    """The stored zone map by runs, and its sizes."""
    mapped = written(rasterize.zone_runs(zones, scene.windows, scene.grid, resolution), "zone-map")
    return mapped, zonal.Bounds.counted(mapped, scene.sizes, resolution is not None)


def kept_cells(cells: DataFrame) -> DataFrame:
    """``cells`` as a table, for queries that read them more than once: held cells, statistics, slices."""
    return written(cells, "cells")


def observed(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Monthly statistics of the nations: the flagship. ``cells``, if given, are a stored table."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir)) if cells is None else cells
    nations = scene.level(1)
    found = stats_of(scene, cells, ["valid_date"], nations)
    due = zonal.present_slices(cells, scene.windows, ["valid_date"])
    return rounded(zonal.densify(found, due, nations, ["valid_date"], scene.n_zones))


# Sources


@query
def tile_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = inputs.tiles(spark, sf_dir)
    grid = grids.Grid(0.0, 8.0, 1.0, 8, 8)
    cells = tile_source.tiles_to_cells(tiles, ["vec_id"], grid)
    return tile_source.with_centres(cells, grid)


def _dated(spark: SparkSession, sf_dir: str, kind: str, *extra: str) -> DataFrame:
    dated = tile_source.with_valid_date(inputs.tiles(spark, sf_dir), kind)
    return dated.select("path", "valid_date", *extra, F.concat_ws(",", "missing").alias("missing"))


@query
def valid_date_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir, "daily")


@query
def valid_date_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir, "monthly")


@query
def valid_date_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir, "forecast", "leadtime")


@query
def date_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.file_catalog(inputs.file_names(spark, sf_dir))


@query
def files_for_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    dates = urgent.select(F.to_date("o_orderdate").alias("valid_date")).distinct()
    files = catalog.file_catalog(inputs.file_names(spark, sf_dir))
    return catalog.select_files(files, "daily/", dates)


@query
def selection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("valid_date"))
    files = catalog.file_catalog(inputs.file_names(spark, sf_dir))
    return catalog.selection_report(catalog.select_files(files, "monthly/", dates), dates)


@query
def latest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = catalog.file_catalog(inputs.file_names(spark, sf_dir))
    return catalog.latest_date(files, "daily/processed/")


@query
def stack_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cells, forecast cells and band cells in one table."""
    n = inputs.side(spark, sf_dir)
    return tile_source.stack(
        [
            inputs.cells_obs(spark, sf_dir),
            inputs.cells_forecast(spark, sf_dir),
            inputs.cells_band(spark, sf_dir, n),
        ]
    )


@query
def grid_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = (
        inputs.tiles(spark, sf_dir)
        .withColumn("dataset", F.concat(F.lit("d"), (F.col("vec_id") % 7).cast("string")))
        .withColumn("x0", F.col("vec_id").cast("double"))
    )
    return tile_source.tile_grids(tiles)


@query
def iso3_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.boundaries(spark, sf_dir).withColumnRenamed("iso_3", "iso3")
    return tables.of_countries(known, SOME_CODES)


@query
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.first_per_key(inputs.boundaries(spark, sf_dir), ["iso_3"], ["listed"])


@query
def stats_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of one country's statistics, read from a table stored by month."""
    path = shared_dir(spark, "stats")
    stored = observed(spark, sf_dir).withColumn("month", F.trunc("valid_date", "MM"))
    stored.write.partitionBy("month").parquet(path)
    found = spark.read.schema(stored.schema).parquet(path)
    return tables.stats_slice(found, "RBX", 1, date(1998, 5, 1)).drop("month")


# Projections and filters


@query
def bbox_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    return grids.clip(inputs.cells_obs(spark, sf_dir), scene.windows, scene.sizes, ["iso3"])


@query
def zone_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = grids.zone_bounds(Scene.of(spark, sf_dir).zones, "iso3", "adm_level")
    return rounded(bounds, "minx", "miny", "maxx", "maxy")


@query
def allnan_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = inputs.cells_patchy(spark, sf_dir, scene.side)
    return zonal.filled_slices(cells, scene.windows, scene.sizes, ["valid_date", "leadtime"])


@query
def coverage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of a dataset with a coverage list, and of one without."""
    known = tables.first_per_key(inputs.boundaries(spark, sf_dir), ["iso_3"], ["listed"]).select(
        F.col("iso_3").alias("iso3"), "src_lvl"
    )
    lists = inputs.coverage(spark, sf_dir)
    parts = [
        quality.with_coverage(known, lists, name).select(F.lit(name).alias("dataset"), "*")
        for name in ("BUILDING", "UNLISTED")
    ]
    return parts[0].unionByName(parts[1])


@query
def level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Scene.of(spark, sf_dir).in_use.select(*ZONE_KEYS, "pcode")


@query
def active_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.active_plans(inputs.plans(spark, sf_dir, _n_codes(spark, sf_dir)), PLANS_AS_OF)


def _n_codes(spark: SparkSession, sf_dir: str) -> int:
    return inputs.side(spark, sf_dir) // 2


@query
def band_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = inputs.cells_band(spark, sf_dir, inputs.side(spark, sf_dir))
    return cells.withColumn("band", tile_source.band_name(F.col("band")))


@query
def issued_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = issued_date(F.col("valid_date"), F.col("leadtime"))
    return inputs.cells_forecast(spark, sf_dir).withColumn("issued_date", due)


QUERIES["issued_date"] = QUERIES.pop("issued_dates")


@query
def max_adm_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = membership_flags(spark, sf_dir)
    level = metadata.max_adm_level(F.col("has_active_hrp"), F.col("src_lvl"))
    return flagged.withColumn("max_adm_level", level)


@query
def split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.plan_countries(inputs.plans(spark, sf_dir, _n_codes(spark, sf_dir)))


@query
def membership_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = metadata.active_plans(
        inputs.plans(spark, sf_dir, _n_codes(spark, sf_dir)), PLANS_AS_OF
    )
    known = tables.first_per_key(inputs.boundaries(spark, sf_dir), ["iso_3"], ["listed"])
    return metadata.flagged(
        known.select(F.col("iso_3").alias("iso3"), "src_lvl"),
        metadata.plan_countries(active),
        "has_active_hrp",
    )


# Rasters and zones


@query
def rasterize_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    return rasterize.zone_map(scene.zones, scene.windows, scene.grid).drop("w")


QUERIES["rasterize"] = QUERIES.pop("rasterize_zones")


@query
def rasterize_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    touched = rasterize.zone_map(scene.zones, scene.windows, scene.grid, all_touched=True)
    return touched.drop("w")


@query
def zone_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone map with the weights that stand for the upsampled raster."""
    scene = Scene.of(spark, sf_dir)
    return rasterize.zone_map(scene.zones, scene.windows, scene.grid, FINE)


@query
def point_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    reach = 10 * scene.side
    return rasterize.points_in_zones(_customer_points(spark, sf_dir, reach), scene.zones, 8.0, "c_custkey")


def _customer_points(spark: SparkSession, sf_dir: str, reach: int) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_custkey") * 37 % reach / F.lit(10.0) + 0.013).alias("x"),
        (F.col("c_custkey") * 91 % reach / F.lit(10.0) + 0.017).alias("y"),
    )


@query
def point_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, by the quadtree cover of all zones."""
    scene = Scene.of(spark, sf_dir)
    points = _customer_points(spark, sf_dir, 10 * scene.side)
    return cover.points_in_cover(points, cover.zone_cover(scene.zones), "c_custkey")


@query
def upsample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    return grids.upsample(inputs.cells_obs(spark, sf_dir), scene.grid, FINE)


@query
def prep_clip_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = inputs.cells_obs(spark, sf_dir)
    return grids.prepared(cells, scene.windows, scene.sizes, scene.grid, FINE, ["iso3"])


def _upsampled_first(scene: Scene, held: DataFrame) -> DataFrame:
    width, height, _ = scene.grid.upsampled(FINE)
    fine_grid = grids.Grid(
        scene.grid.x0, scene.grid.y0, scene.grid.width * scene.grid.res / width, width, height
    )
    spans = grids.country_windows(scene.zones, fine_grid)
    return rasterize.zone_map_upsampled_first(scene.level(1), spans, scene.grid, FINE, held)


@query
def prep_order_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and counts of the nations for both orders of clipping and upsampling."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    held = written(grids.held_cells(cells, scene.grid), "held")
    maps = {
        "clip_first": rasterize.zone_map(scene.level(1), scene.windows, scene.grid, FINE, cells=held),
        "upsample_first": _upsampled_first(scene, held),
    }
    parts = []
    for order, made in maps.items():
        mapped = written(made, "zone-map")
        bounds = zonal.Bounds.counted(mapped, scene.sizes, True)
        stats = zonal.zonal_stats(
            cells, mapped, scene.grid, bounds, ["valid_date"], ("mean", "count")
        )
        parts.append(
            rounded(stats).withColumnsRenamed({"mean": f"mean_{order}", "count": f"count_{order}"})
        )
    return parts[0].join(parts[1], ["valid_date", *ZONE_KEYS], "full")


@query
def simplify_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = simplify.simplify_vertices(inputs.borders(spark, sf_dir), ["nation"], TOLERANCE)
    return rounded(kept, "x", "y")


@query
def dissolve_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    return rasterize.dissolved_pixels(scene.level(2), scene.windows, scene.grid)


@query
def zone_area_km2(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    zones = inputs.in_degrees(scene.zones, scene.side)
    return areas.areas_km2(zones).withColumn("area", F.round("area", 3))


@query
def shoelace_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(areas.planar_areas(Scene.of(spark, sf_dir).zones), "area")


# Statistics


@query
def cell_zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    mapped, bounds = map_of(scene, scene.zones)
    return zonal.cells_in_zones(cells, mapped, scene.grid, bounds).drop("w")


@query
def zonal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed(spark, sf_dir)


def _found_and_due(
    scene: Scene, cells: DataFrame, keys: list[str], zones: DataFrame, resolution: float | None
) -> tuple[DataFrame, DataFrame]:
    """Stored statistics and the slices due, by one pass over the cells' values."""
    cells = kept_cells(cells)
    found = written(stats_of(scene, cells, keys, zones, resolution), "found")
    present = zonal.present_slices(cells, scene.windows, keys)
    due = zonal.filled_slices_after(found, present, cells, scene.windows, scene.sizes, keys)
    return found, due


def _forecast(
    scene: Scene, cells: DataFrame, zones: DataFrame, resolution: float | None
) -> DataFrame:
    keys = ["valid_date", "leadtime"]
    found, due = _found_and_due(scene, cells, keys, zones, resolution)
    rows = zonal.densify(found, due, zones, keys, scene.n_zones)
    issued = issued_date(F.col("valid_date"), F.col("leadtime"))
    return rounded(rows.withColumn("issued_date", issued))


@query
def zonal_stats_leadtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = inputs.cells_patchy(spark, sf_dir, scene.side)
    return _forecast(scene, cells, scene.level(1), None)


@query
def zonal_stats_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = inputs.cells_band(spark, sf_dir, scene.side).withColumn(
        "band", tile_source.band_name(F.col("band"))
    )
    keys = ["valid_date", "band"]
    found, due = _found_and_due(scene, cells, keys, scene.level(1), None)
    rows = zonal.densify(found, due, scene.level(1), keys, scene.n_zones)
    return rounded(rows, "mean", "median", "sum", "std")


@query
def zonal_stats_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels of all countries at once, over the upsampled raster."""
    scene = Scene.of(spark, sf_dir)
    return _forecast(scene, inputs.cells_forecast(spark, sf_dir), scene.in_use, FINE)


@query
def zonal_stats_large_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted statistics by the plan for zones too large for one task."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    mapped, bounds = map_of(scene, scene.level(0), FINE)
    keys = ["valid_date", *ZONE_KEYS]
    matched = zonal.cells_in_zones(cells, mapped, scene.grid, bounds).withColumnRenamed("value", "v")
    return rounded(zonal.split_stats(matched, keys, [*STAT_COLUMNS, "unique"]))


@query
def stat_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    return rounded(
        stats_of(scene, cells, ["valid_date"], scene.zones, None, ("mean", "max", "count"))
    )


@query
def unique_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_nan(spark, sf_dir))
    return stats_of(scene, cells, ["valid_date"], scene.zones, FINE, ("count", "unique"))


@query
def densify_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier zones, most of them empty in a month, over a raster with missing values."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_nan(spark, sf_dir))
    suppliers = scene.level(2)
    found = stats_of(scene, cells, ["valid_date"], suppliers)
    due = zonal.present_slices(cells, scene.windows, ["valid_date"])
    return rounded(zonal.densify(found, due, suppliers, ["valid_date"], scene.n_zones))


def _degree_sources(n: int) -> list[metadata.RasterSource]:
    coarse, fine = inputs.grid_in_degrees(n), inputs.grid_in_degrees(n, 2)
    return [
        metadata.RasterSource("coarse", coarse, coarse.res * FINE),
        metadata.RasterSource("fine", fine, None, DEGREE_COVERAGE),
    ]


@query
def pixel_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    zones = inputs.in_degrees(scene.zones, scene.side)
    counts = metadata.pixel_counts(zones, _degree_sources(scene.side)[0])
    return rounded(counts, "frac_raw_pixels")


@query
def polygon_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    scene = Scene.of(spark, sf_dir)
    zones = inputs.in_degrees(scene.in_use, scene.side).withColumn("name_language", F.lit("EN"))
    made = metadata.polygon_table(zones, _degree_sources(scene.side))
    return rounded(
        made.withColumn("area", F.round("area", 3)),
        "coarse_frac_raw_pixels",
        "fine_frac_raw_pixels",
    )


# Country metadata


@query
def pcode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.pcode_counts(inputs.pcodes(spark, sf_dir, _n_codes(spark, sf_dir)))


@query
def pcode_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.pcode_columns(pcode_counts(spark, sf_dir))


@query
def iso3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = max_adm_level(spark, sf_dir).select("iso3", "max_adm_level")
    return levels.join(pcode_pivot(spark, sf_dir), "iso3")


@query
def total_pcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.with_total(iso3_counts(spark, sf_dir))


@query
def iso3_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _n_codes(spark, sf_dir)
    return metadata.iso3_table(
        inputs.boundaries(spark, sf_dir),
        inputs.plans(spark, sf_dir, n),
        inputs.pcodes(spark, sf_dir, n),
        {"floodscan": SOME_CODES},
        PLANS_AS_OF,
        "listed",
    )


@query
def admin_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layers with their own column names: regions, nations, suppliers."""
    region = table(spark, sf_dir, "region").select(
        inputs.iso3_of(F.col("r_regionkey")).alias("ISO3"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("ADM0_PCODE"),
        F.col("r_name").alias("ADM0_EN"),
        F.lit("unused").alias("ADM0_REF"),
        "r_regionkey",
    )
    nation = (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "ISO3",
            "ADM0_PCODE",
            F.col("ADM0_EN").alias("ADM0_FR"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ADM1_PCODE"),
            F.col("n_name").alias("ADM1_FR"),
            F.upper("n_name").alias("ADM1_EN"),
            "n_nationkey",
        )
    )
    supplier = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "ISO3",
            "ADM0_PCODE",
            F.col("ADM0_FR").alias("ADM0_ES"),
            "ADM1_PCODE",
            F.col("ADM1_FR").alias("ADM1_ES"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ADM2_PCODE"),
            F.col("s_name").alias("ADM2_ES"),
        )
    )
    return tables.admin_lookup([(region, 0), (nation, 1), (supplier, 2)])


# Runs


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("valid_date"))


def _span(days: DataFrame) -> DataFrame:
    return days.agg(F.min("valid_date").alias("first"), F.max("valid_date").alias("last"))


@query
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = _span(_order_days(spark, sf_dir))
    parts = [
        runs.expected_dates(span, F.col("first"), F.col("last"), f).select(
            F.lit(f).alias("frequency"), "valid_date"
        )
        for f in ("D", "M")
    ]
    return parts[0].unionByName(parts[1])


@query
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    expected = runs.expected_dates(_span(days), F.col("first"), F.col("last"), "D")
    return runs.missing_dates(expected, days)


@query
def missing_issue_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in which goods were shipped, but no order issued: the last ones."""
    shipped = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("valid_date"))
    expected = runs.expected_dates(_span(shipped), F.col("first"), F.col("last"), "M")
    issued = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").alias("issued_date"))
    return runs.missing_dates(expected, issued, "issued_date")


@query
def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = _span(_order_days(spark, sf_dir))
    planned = runs.planned_dates(span, F.date_add("first", 14), F.col("last"), "M")
    return runs.run_dates(planned, missing_dates(spark, sf_dir))


@query
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.date_chunks(_order_days(spark, sf_dir).distinct())


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = missing_dates(spark, sf_dir)
    plan = runs.date_chunks(run_dates(spark, sf_dir))
    return runs.run_summary(plan, "orders", "backfill", missing, "RAX,RBX")


@query
def update_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the newest month, laid over those of the months before."""
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    names = cells.select(
        F.concat(F.lit("monthly/p_"), F.col("valid_date").cast("string"), F.lit(".tif")).alias("path")
    ).distinct()
    newest = catalog.latest_date(catalog.file_catalog(names), "monthly/")
    marked = cells.withColumn("newest", newest.scalar())
    before = observed(spark, sf_dir, marked.filter("valid_date < newest").drop("newest"))
    update = observed(spark, sf_dir, marked.filter("valid_date = newest").drop("newest"))
    return merge.upsert(before, update, ["valid_date", "iso3", "pcode"])


@query
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that lacks every spring is filled with the missing months."""
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    stored = observed(spark, sf_dir, cells.filter(~F.month("valid_date").isin(3, 4, 5)))
    span = _span(cells)
    expected = runs.expected_dates(span, F.col("first"), F.col("last"), "M")
    missing = runs.missing_dates(expected, stored)
    late = observed(spark, sf_dir, cells.join(missing, "valid_date", "left_semi"))
    return merge.upsert(stored, late, ["valid_date", "iso3", "pcode"])


# Quality


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(inputs.stats_rows(spark, sf_dir), AS_OF)


def _in_chunks(rows: DataFrame) -> DataFrame:
    chunks = runs.date_chunks(rows.select("valid_date").distinct(), CHUNK_SIZE)
    return rows.join(small(chunks, chunks.count()), "valid_date")


@query
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir).withColumn("violations", F.concat_ws(",", "violations"))
    return checked.select("pcode", "valid_date", "leadtime", "adm_level", "violations")


@query
def validate_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.stats_rows(spark, sf_dir).drop("issued_date", "leadtime")
    checked = quality.validate(rows, AS_OF)
    return checked.select("pcode", "valid_date", F.concat_ws(",", "violations").alias("violations"))


@query
def violation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_summary(_checked(spark, sf_dir), "adm_level")


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _in_chunks(_checked(spark, sf_dir))
    failed = quality.failed_units(checked, jobs.UNIT)
    kept = quality.passed(checked, failed, jobs.UNIT)
    return kept.select("iso3", "chunk_id", "pcode", "valid_date", "leadtime", "mean", "count")


@query
def qa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = quality.failed_units(_in_chunks(_checked(spark, sf_dir)), jobs.UNIT)
    at = F.lit(AS_OF).cast("timestamp")
    return quality.qa_rows(failed, "seas5", at)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(inputs.keyed_rows(spark, sf_dir), ["pcode", "leadtime"])


@query
def duplicate_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.keyed_rows(spark, sf_dir).select(
        "*", F.array().cast("array<string>").alias("violations")
    )
    marked = quality.with_duplicate_rule(rows, ["pcode", "leadtime"])
    return marked.groupBy("flag", F.concat_ws(",", "violations").alias("violations")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def empty_clip_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier countries against a raster of the lower half of the scene."""
    scene = Scene.of(spark, sf_dir)
    boxes = scene.level(2).withColumn("iso3", F.col("pcode"))
    lower = grids.Grid(0.0, scene.side / 2.0, 1.0, scene.side, scene.side // 2)
    spans = grids.windows(grids.zone_bounds(boxes, "iso3"), lower)
    missed = quality.outside_grid(boxes.select("iso3"), spans)
    return quality.qa_rows(missed, "coarse", F.lit(AS_OF).cast("timestamp"), kind=None)


@query
def upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.keyed_rows(spark, sf_dir)
    key = ["pcode", "leadtime"]
    stored = tables.last_per_key(rows, key, ["seq"]).drop("seq")
    arrived = tables.last_per_key(rows.filter("flag = 'R'"), key, ["seq"]).drop("seq")
    incoming = arrived.withColumn("mean", F.col("mean") + 1000)
    return merge.upsert(stored, incoming, key)


@query
def compare_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain statistics of the nations against both upsampled forms."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    stats = ("mean", "median", "min", "max")
    nations = scene.level(1)
    held = written(grids.held_cells(cells, scene.grid), "held")
    forms = {
        "db": rasterize.zone_map(nations, scene.windows, scene.grid, None, cells=held),
        "up": rasterize.zone_map(nations, scene.windows, scene.grid, FINE, cells=held),
        "late": _upsampled_first(scene, held),
    }
    # One zone map of all forms, so the cells are joined and grouped once.
    mapped = reduce(
        DataFrame.unionByName,
        [m.select("*", F.lit(name).alias("form")) for name, m in forms.items()],
    )
    mapped = written(mapped.withColumn("iso3", F.concat_ws("/", "form", "iso3")).drop("form"), "forms")
    bounds = zonal.Bounds.counted(mapped, scene.sizes, True)
    together = written(
        zonal.zonal_stats(cells, mapped, scene.grid, bounds, ["valid_date"], stats), "found"
    )
    form, iso3 = F.split("iso3", "/")[0], F.split("iso3", "/")[1]
    found = {
        name: together.filter(form == name).withColumn("iso3", iso3) for name in forms
    }
    compared = merge.compare(found, "db", ["valid_date", *ZONE_KEYS], stats)
    return rounded(compared, "mean_db", "mean_up", "mean_late")


# Streaming


def _tile_layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Zones of the small tiles, and the levels their countries use."""
    zones = inputs.zones(spark, sf_dir, inputs.TILE_SIDE).filter("adm_level < 2")
    return zones, zones.select("iso3").distinct().withColumn("max_adm_level", F.lit(1))


def _as_doubles(stored: DataFrame) -> DataFrame:
    return stored.drop("month").withColumns(
        {c: F.col(c).cast("double") for c in STAT_COLUMNS if c != "count"}
    )


@query
def stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of tiles read as a stream in four batches, which part every slice among them."""
    zones, levels = _tile_layers(spark, sf_dir)
    fixed = jobs.layers(zones, levels, inputs.grid_of_side(inputs.TILE_SIDE), None)
    store, log = shared_dir(spark, "stream-stats"), shared_dir(spark, "stream-qa")
    folder = shared_dir(spark, "stream-tiles")
    blocks = tile_source.in_blocks(
        to_schema(inputs.tiles_from(table(spark, sf_dir, "embeddings")), TILES), 4
    )
    blocks.repartition(4, "x0", "y0").sortWithinPartitions("path").write.parquet(folder)
    arriving = updates.arriving_tiles(spark, folder, files_per_batch=1)
    stored = jobs.dated_tiles(spark.read.schema(TILES).parquet(folder), STREAM_SPEC)
    # A tile a day passes any fixed date, and then whole countries would be held back.
    newest = stored.agg(F.max("valid_date")).first()[0]
    as_of = max(FAR_AHEAD, newest or FAR_AHEAD)

    def handle(batch: DataFrame) -> None:
        changed = jobs.dated_tiles(batch, STREAM_SPEC)
        tiles = updates.touched_slices(changed, stored, STREAM_SPEC.slice_keys)
        rows = jobs.statistics(
            tiles.withColumn("chunk_id", F.lit(0)), fixed, STREAM_SPEC, "chunk_id"
        )
        jobs.store(rows, STREAM_SPEC, store, log, as_of)

    updates.keep_updated(arriving, handle, shared_dir(spark, "stream-state")).awaitTermination()
    return _as_doubles(spark.read.parquet(store))


# Runs on stored tiles


class Archive:
    """A run of the statistics job over tiles stored in blocks, some undated, some stored twice."""

    def __init__(self, spark: SparkSession, sf_dir: str, late: bool = False):
        folder = shared_dir(spark, "archive")
        self.stats, self.qa = f"{folder}/stats", f"{folder}/qa"
        made = inputs.tiles(spark, sf_dir)
        again = made.filter("vec_id % 10 = 3").withColumn(
            "path", F.regexp_replace("path", "[.]tif$", "_rev.tif")
        )
        tiles = to_schema(made.unionByName(again), TILES)
        zones, levels = _tile_layers(spark, sf_dir)

        def run(part: DataFrame, path: str, **options: bool) -> dict[str, object]:
            tile_source.write_tiles(part, path, block=3)
            stored = tile_source.read_tiles(spark, path, STREAM_SPEC.name)
            return jobs.run_statistics(
                spark, STREAM_SPEC, stored, zones, levels, self.stats, self.qa, FAR_AHEAD,
                resolution=None, **options,
            )

        if late:
            # A first run of every third day, then one that backfills the others.
            third = F.datediff("day", F.lit("2020-01-01")) % 3 == 0
            days = to_schema(made.filter(third), TILES)
            run(days, f"{folder}/some")
            tiles = to_schema(made, TILES)
            self.report = run(tiles, f"{folder}/all", update=True, backfill=True)
        else:
            self.report = run(tiles, f"{folder}/tiles")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Archive:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _ARCHIVES:
            _ARCHIVES[key] = cls(spark, sf_dir)
        return _ARCHIVES[key]


_ARCHIVES: dict[tuple[str, str], Archive] = {}


@query
def archive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run stored: neither undated slices nor those stored twice."""
    return _as_doubles(spark.read.parquet(Archive.of(spark, sf_dir).stats))


@query
def qa_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log: the run has no line of a country, so one that came would part from the twin."""
    return spark.read.parquet(Archive.of(spark, sf_dir).qa).drop("date")


@query
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = Archive.of(spark, sf_dir).report
    names = ["dataset", "mode", "n_missing", "n_files", "n_undated", "n_failed", "n_conflicts"]
    kinds = "dataset string, mode string, n_missing long, n_files long, n_undated long, n_failed long, n_conflicts long"
    return spark.createDataFrame([tuple(report[n] for n in names)], kinds)


@query
def backfill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run into nothing, and a second that updates and fills what the first lacked."""
    return _as_doubles(spark.read.parquet(Archive(spark, sf_dir, late=True).stats))


@query
def multi_tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters in blocks of five: the grid spans them all, the statistics are those of one tile."""
    zones, levels = _tile_layers(spark, sf_dir)
    whole = to_schema(inputs.tiles_from(table(spark, sf_dir, "embeddings")), TILES)
    blocks = written(tile_source.in_blocks(whole, 5), "blocks")
    fixed = jobs.layers(zones, levels, tile_source.grid_of(blocks), None)
    rows = jobs.statistics(jobs.dated_tiles(blocks, STREAM_SPEC), fixed, STREAM_SPEC)
    stored = to_schema(rows, jobs.stats_schema(STREAM_SPEC))
    return _as_doubles(stored.withColumn("dataset", F.lit("embeddings")).withColumn("month", F.lit(0)))


@query
def conflicting_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices with a tile stored twice, and slices with blocks that overlap by one column."""
    made = inputs.tiles_from(table(spark, sf_dir, "embeddings"))
    blocks = tile_source.in_blocks(made, 4)
    twice = blocks.filter("vec_id % 10 = 3 AND x0 = 0 AND y0 = 8")
    shifted = blocks.filter("vec_id % 10 = 4 AND x0 = 4").withColumn("x0", F.col("x0") - 1)
    parts = blocks.filter("vec_id % 10 != 4 OR x0 != 4").unionByName(twice).unionByName(shifted)
    return tile_source.conflicting_slices(parts, ["day"], inputs.grid_of_side(inputs.TILE_SIDE))


@query
def simplify_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' borders and a sliver each as zones, divided by Spark beyond ``FEW_VERTICES``."""
    point = F.struct("x", "y")
    lines = inputs.borders(spark, sf_dir).groupBy("nation").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", point.alias("p")))), lambda v: v["p"]).alias("line")
    )
    sliver = F.array(
        *[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.0, 0.001), (2.0, 0.0))]
    )
    zones = lines.select(
        F.lit("AAA").alias("iso3"),
        F.lit(0).alias("adm_level"),
        F.col("nation").cast("int").alias("zone_idx"),
        F.array("line", sliver).cast(RINGS).alias("rings"),
    )
    thin = simplify.simplify_zones(written(zones, "borders"), TOLERANCE, FEW_VERTICES)
    rings = thin.select("zone_idx", F.posexplode("rings").alias("ring_no", "ring"))
    corners = rings.select("zone_idx", "ring_no", F.posexplode("ring").alias("nth", "p"))
    return rounded(corners.select("zone_idx", "ring_no", "nth", "p.x", "p.y"), "x", "y")


@query
def zonal_stats_mixed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones on both sides of the limit for one task, taken at a tenth of the largest window."""
    scene = Scene.of(spark, sf_dir)
    mapped, bounds = map_of(scene, scene.zones)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    limit = scene.sizes.largest // 10
    large = zonal.zones_over(mapped, limit)
    return rounded(
        zonal.zonal_stats(cells, mapped, scene.grid, bounds, ["valid_date"], local_cells=limit, large=large),
        "mean", "median", "sum", "std",
    )


@query
def level_filter_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own level filter, over all zones of the scene."""
    scene = Scene.of(spark, sf_dir)
    return jobs.to_deepest_level(scene.zones, inputs.countries(spark, sf_dir)).select(*ZONE_KEYS, "pcode")


@query
def stored_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones written to the shared folder and read back by country."""
    path = shared_dir(spark, "zones")
    tables.write_zones(Scene.of(spark, sf_dir).zones, path)
    return tables.read_zones(spark, path).select(*ZONE_KEYS, "pcode")


# Exact coverage and running sums

QUARTILES = (0.25, 0.75)


@query
def coverage_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The covered share of every cell of all zones."""
    scene = Scene.of(spark, sf_dir)
    return rounded(coverage.coverage_weights(scene.zones, scene.grid), "w").filter("w > 0")


def _exact(spark: SparkSession, sf_dir: str, stats: tuple[str, ...], quantiles: tuple[float, ...] = ()) -> DataFrame:
    """Monthly statistics of the nations, weighted by coverage."""
    scene = Scene.of(spark, sf_dir)
    cells = kept_cells(inputs.cells_obs(spark, sf_dir))
    held = grids.held_cells(cells, scene.grid)
    weights = written(coverage.coverage_weights(scene.level(1), scene.grid, held), "weights")
    return coverage.exact_stats(cells, weights, scene.grid, weights.count(), ["valid_date"], stats, quantiles)


@query
def zonal_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_exact(spark, sf_dir, coverage.STATISTICS, QUARTILES), "mean", "sum", "std", "count")


@query
def compare_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics by cell centres against those by exact coverage, where they are far apart."""
    stats = ("mean", "median", "min", "max")
    scene = Scene.of(spark, sf_dir)
    centres = stats_of(scene, kept_cells(inputs.cells_obs(spark, sf_dir)), ["valid_date"], scene.level(1), None, stats)
    found = {"db": centres, "ee": _exact(spark, sf_dir, stats)}
    return rounded(merge.compare(found, "db", ["valid_date", *ZONE_KEYS], stats), "mean_db", "mean_ee")


@query
def zonal_stats_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly statistics of all zones by running sums along rows."""
    scene = Scene.of(spark, sf_dir)
    mapped = rasterize.zone_runs(scene.zones, scene.windows, scene.grid)
    runs = written(spans.zone_runs(mapped), "runs")
    found = spans.run_stats(inputs.cells_obs(spark, sf_dir), runs, scene.grid, runs.count(), ["valid_date"])
    return rounded(found, "mean", "sum", "std")


# Gaps, shared borders, and what the sinks store


@query
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days on which a nation has no order, between the first and the last order of all."""
    stored = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    stored = stored.select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("iso3"),
        F.lit(0).alias("adm_level"),
        F.to_date("o_orderdate").alias("valid_date"),
    )
    first, last = stored.agg(F.min("valid_date"), F.max("valid_date")).first()
    levels = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso3"), F.lit(0).alias("adm_level")
    )
    return runs.missing_intervals(stored, levels, first, last, "D")


@query
def simplify_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone below and one above each nation's border, which stays common to both."""
    n = table(spark, sf_dir, "customer").count()
    line = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.struct((F.col("c_custkey") / F.lit(n)).alias("x"), (F.col("c_acctbal") / 50_000 + 10 * F.col("c_nationkey")).alias("y")).alias("p"),
    )
    lines = line.groupBy("nation").agg(F.array_sort(F.collect_list("p")).alias("line")).filter(F.size("line") > 1)
    corner = lambda x, up: F.struct(x.alias("x"), (10.0 * F.col("nation") + up).alias("y"))
    left, right = F.element_at("line", 1)["x"], F.element_at("line", -1)["x"]
    below = F.concat("line", F.array(corner(right, -2.0), corner(left, -2.0)))
    above = F.concat(F.reverse("line"), F.array(corner(left, 2.0), corner(right, 2.0)))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("up"), below.alias("ring")), F.struct(F.lit(1).alias("up"), above.alias("ring"))))
    zones = lines.select("nation", sides.alias("side")).select(
        F.lit("AAA").alias("iso3"),
        F.lit(0).alias("adm_level"),
        (2 * F.col("nation") + F.col("side.up")).cast("int").alias("zone_idx"),
        F.array("side.ring").cast(RINGS).alias("rings"),
    )
    thin = topology.simplify_shared(written(zones, "neighbours"), TOLERANCE, FEW_VERTICES)
    corners = thin.select("zone_idx", F.posexplode(F.element_at("rings", 1)).alias("nth", "p"))
    return rounded(corners.select("zone_idx", "p.x", "p.y"), "x", "y")


@query
def tagged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a headered CSV in many files, with a tag row in one, and read back."""
    path = shared_dir(spark, "tagged")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"))
    tags = spark.range(1).select(F.lit("#adm+code").alias("code"), F.lit("#adm+name").alias("name"))
    tags.union(rows).write.option("header", True).csv(path)
    return tables.read_tagged_csv(spark, path, "code string, name string")


@query
def iso3_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country table as stored the second time."""
    path, made = shared_dir(spark, "iso3"), iso3_meta(spark, sf_dir)
    for rows in (made.withColumn("has_active_hrp", F.lit(None).cast("boolean")), made):
        sinks.write_iso3(rows, path)
    return spark.read.parquet(path)


@query
def polygons_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon metadata stored with other names for one level, then again as they are."""
    path, made = shared_dir(spark, "polygons"), written(polygon_meta(spark, sf_dir), "polygon-meta")
    sinks.write_polygons(made.filter("adm_level = 1").withColumn("name", F.lit("old")), path)
    sinks.write_polygons(made, path)
    return spark.read.parquet(path)


@query
def lookup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "lookup")
    sinks.write_lookup(admin_lookup(spark, sf_dir), path)
    return spark.read.parquet(path)
