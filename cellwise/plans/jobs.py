"""The three jobs: statistics (archive, update, backfill), and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.dates import issued_date
from cellwise.operators.grid import RESOLUTION, Grid, Sizes, country_windows, measure
from cellwise.operators.quality import (
    failed_units,
    outside_grid,
    passed,
    qa_rows,
    validate,
    with_coverage,
    with_duplicate_rule,
)
from cellwise.operators.rasterize import zone_map
from cellwise.operators.simplify import TOLERANCE, simplify_zones
from cellwise.operators.zonal import (
    Bounds,
    densify,
    filled_slices_after,
    present_slices,
    zonal_stats,
)
from cellwise.plans.metadata import RasterSource, polygon_table
from cellwise.plans.runs import missing_of, run_plan, run_summary
from cellwise.schema import DatasetSpec, coverage_table, stats_schema
from cellwise.session import run_tables, written
from cellwise.sources.catalog import (
    file_catalog,
    latest_date,
    select_files,
    selection_report,
    undated_files,
)
from cellwise.sources.sinks import (
    append_qa,
    existing,
    table_schema,
    write_iso3,
    write_polygons,
    write_stats,
)
from cellwise.sources.tables import of_countries
from cellwise.sources.tiles import (
    band_name,
    conflicting_slices,
    grid_of,
    kind_of,
    missing_attributes,
    tiles_near,
    tiles_of_dates,
    tiles_to_cells,
    with_valid_date,
    without_slices,
)

UNIT = ["iso3", "chunk_id"]


@dataclass(frozen=True)
class Layers:
    """Everything about zones that is fixed for a run: built once, used for every slice."""

    zones: DataFrame
    spans: DataFrame
    zone_map: DataFrame
    grid: Grid
    sizes: Sizes
    bounds: Bounds
    n_zones: int


def to_deepest_level(zones: DataFrame, countries: DataFrame) -> DataFrame:
    """Zones of the given countries, from level 0 down to each country's ``max_adm_level``."""
    deepest = countries.select("iso3", "max_adm_level")
    return zones.join(deepest, "iso3").filter("adm_level <= max_adm_level").drop("max_adm_level")


def layers(
    zones: DataFrame,
    countries: DataFrame,
    grid: Grid,
    resolution: float | None,
    tolerance: float | None = TOLERANCE,
) -> Layers:
    """Rasterise the zones of the given countries, each down to its deepest level.

    Zones are simplified before they are rasterised, unless the tolerance is ``None``; clip
    windows are those of the zones as they came.
    """
    wanted = written(to_deepest_level(zones, countries), "zones")
    spans = written(country_windows(wanted, grid), "windows")
    sizes = measure(spans)
    drawn = wanted if tolerance is None else simplify_zones(wanted, tolerance)
    mapped = written(zone_map(drawn, spans, grid, resolution), "zone-map")
    bounds = Bounds.counted(mapped, sizes, weighted=resolution is not None)
    return Layers(wanted, spans, mapped, grid, sizes, bounds, wanted.count())


def dated_tiles(tiles: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Tiles with their valid date and their extra dimension named; undatable ones are left out."""
    dated = with_valid_date(tiles, kind_of(spec), list(spec.extra_dims)).filter("valid_date IS NOT NULL")
    if "band" in spec.extra_dims:
        dated = dated.withColumn("band", band_name(F.col("band")))
    return dated


def statistics(tiles: DataFrame, fixed: Layers, spec: DatasetSpec, *carried: str) -> DataFrame:
    """All due rows for dated tiles: every slice and zone, levels together.

    ``carried`` are further columns that a slice determines, such as its chunk. A slice of a
    dataset with an extra dimension gives no rows for countries where it holds no value. Cells
    are read once; what follows works on the stored statistics.
    """
    keys = [*spec.slice_keys, *carried]
    cells = tiles_to_cells(tiles_near(tiles, fixed.sizes, fixed.grid), keys, fixed.grid)
    found = written(
        zonal_stats(cells, fixed.zone_map, fixed.grid, fixed.bounds, keys), f"{spec.name}-found"
    )
    due = present_slices(tiles, fixed.spans, keys)
    if spec.extra_dims:
        due = filled_slices_after(found, due, cells, fixed.spans, fixed.sizes, keys)
    rows = densify(found, due, fixed.zones, keys, fixed.n_zones)
    if "leadtime" in spec.extra_dims:
        rows = rows.withColumn("issued_date", issued_date(F.col("valid_date"), F.col("leadtime")))
    return rows


def store(
    rows: DataFrame, spec: DatasetSpec, stats_path: str, qa_path: str, as_of: date
) -> DataFrame:
    """Validate, hold back the countries that fail, upsert the rest; returns the failed units.

    A key may occur once per country and chunk of dates, which is what is held back together. A
    p-code that two countries share is stored for both.
    """
    stored_form = stats_schema(spec)
    # Rules apply to what is stored, so values are first cut to the table's precision.
    narrowed = rows.withColumns(
        {f.name: F.col(f.name).cast(f.dataType) for f in stored_form.fields if f.name in rows.columns}
    )
    valid = written(validate(narrowed, as_of), f"{spec.name}-valid")
    checked = with_duplicate_rule(valid, [*UNIT, *spec.key])
    failed = written(failed_units(checked, UNIT), f"{spec.name}-failed")
    append_qa(qa_rows(failed, spec.name), qa_path)
    write_stats(passed(checked, failed, UNIT), spec, stats_path)
    return failed


def run_statistics(
    spark: SparkSession,
    spec: DatasetSpec,
    tiles: DataFrame,
    zones: DataFrame,
    countries: DataFrame,
    stats_path: str,
    qa_path: str,
    as_of: date,
    update: bool = False,
    backfill: bool = False,
    test: bool = False,
    resolution: float | None = RESOLUTION,
    tolerance: float | None = TOLERANCE,
    strict_empty: bool = False,
) -> dict[str, object]:
    """Compute and store a dataset's statistics; returns counts for the run's report.

    The tables in between are deleted when the run ends.
    """
    with run_tables(spark):
        return _run_statistics(
            spark, spec, tiles, zones, countries, stats_path, qa_path, as_of, update, backfill,
            test, resolution, tolerance, strict_empty,
        )


def _run_statistics(
    spark: SparkSession,
    spec: DatasetSpec,
    tiles: DataFrame,
    zones: DataFrame,
    countries: DataFrame,
    stats_path: str,
    qa_path: str,
    as_of: date,
    update: bool,
    backfill: bool,
    test: bool,
    resolution: float | None,
    tolerance: float | None,
    strict_empty: bool,
) -> dict[str, object]:
    """One run.

    Without flags the whole archive is computed; with ``update`` the newest file's date, and
    with ``backfill`` the dates the stored table lacks. A country fails as a whole within a
    chunk of dates, and leaves a row in the error log instead of statistics. A slice whose tiles
    overlap, such as one stored twice, is left out and logged. In a test, the dataset's test
    countries and, if it has one, its test window of dates are computed.
    """
    mine = tiles.filter(F.col("dataset") == spec.name)
    paths = mine.select("path").distinct()
    # The names alone, read once for the catalogue, the newest date and what has no date.
    paths = written(paths, f"{spec.name}-paths")
    catalog = file_catalog(paths)
    stored = _stored(spark, spec, stats_path) if backfill else None
    newest = latest_date(catalog, spec.prefix) if update else None
    if test:
        spec = spec.in_test()
    # Stored, as it follows from the table that this run changes.
    plan = written(run_plan(spark, spec, as_of, stored, newest, backfill), f"{spec.name}-plan")
    missing = None if stored is None else missing_of(spark, spec, as_of, stored)
    selected = select_files(catalog, spec.prefix, plan)
    mode = "test" if test else "full"
    report = {
        **run_summary(plan, spec.name, mode, missing, ",".join(spec.test_iso3s) if test else "")
        .first()
        .asDict(),
        **selection_report(selected, plan).first().asDict(),
        "n_undated": undated_files(paths).count(),
    }
    if report["n_files"] == 0:
        raise ValueError(f"{spec.name}: no file for any of the {report['n_dates']} dates")

    chosen = tiles_of_dates(mine, spec.prefix, plan)

    codes = list(spec.test_iso3s) if test else None
    covered = of_countries(countries, codes)
    if spec.coverage is not None:
        covered = with_coverage(covered, coverage_table(spark, [spec]), spec.name)
    grid = grid_of(mine)
    fixed = layers(zones, covered, grid, resolution, tolerance)

    empty = _without_pixels(fixed)
    nowhere = ["CAST(NULL AS STRING) AS iso3", "CAST(NULL AS INT) AS adm_level"]
    dated = with_valid_date(chosen, kind_of(spec), list(spec.extra_dims))
    undated = missing_attributes(dated).distinct().selectExpr(
        *nowhere, "'missing_attribute' AS rule", "concat(path, ' lacks ', missing) AS detail"
    )
    usable = dated_tiles(chosen, spec)
    conflicts = written(conflicting_slices(usable, spec.slice_keys, grid), f"{spec.name}-conflicts")
    doubled = conflicts.selectExpr(
        *nowhere,
        "'conflicting_tiles' AS rule",
        f"concat_ws(' ', {', '.join(f'CAST({k} AS STRING)' for k in spec.slice_keys)}) AS detail",
    )
    troubles = undated.unionByName(doubled)
    for found in (outside_grid(covered, fixed.spans), empty):
        troubles = troubles.unionByName(found.withColumn("detail", F.lit(None).cast("string")))
    append_qa(qa_rows(troubles, spec.name, kind=None), qa_path)

    usable = without_slices(usable, conflicts, spec.slice_keys)
    rows = statistics(usable, fixed, spec, "chunk_id")
    if strict_empty:
        rows = rows.join(empty.select("iso3").distinct(), "iso3", "left_anti")
    failed = store(rows, spec, stats_path, qa_path, as_of)
    report["n_failed"] = failed.count()
    report["n_conflicts"] = conflicts.count()
    return report


def _stored(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """What is stored of a dataset; before its first run, nothing."""
    table = existing(spark, path, table_schema(spec))
    if table is None:
        table = spark.createDataFrame([], table_schema(spec))
    return table.filter(F.col("dataset") == spec.name)


def _without_pixels(fixed: Layers) -> DataFrame:
    """Countries and levels none of whose zones holds a pixel, though the raster covers them."""
    inside = fixed.zones.join(fixed.spans.select("iso3"), "iso3", "left_semi")
    present = fixed.zone_map.select("iso3", "adm_level").distinct()
    return (
        inside.select("iso3", "adm_level")
        .distinct()
        .join(present, ["iso3", "adm_level"], "left_anti")
        .withColumn("rule", F.lit("no_pixels"))
    )


def run_metadata(
    iso3: DataFrame,
    zones: DataFrame,
    sources: Sequence[RasterSource],
    iso3_path: str,
    polygon_path: str,
    countries: Sequence[str] | None = None,
) -> None:
    """Replace the country table and upsert the polygon table, each as one job.

    With ``countries``, only their polygons are computed.
    """
    spark = iso3.sparkSession
    write_iso3(iso3, iso3_path)
    stored = spark.read.parquet(iso3_path).select("iso3", "max_adm_level")
    if countries is not None:
        stored = of_countries(stored, countries)
    with run_tables(spark):
        write_polygons(polygon_table(to_deepest_level(zones, stored), sources), polygon_path)
