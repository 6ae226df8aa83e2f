"""Country and polygon metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.functions.values import codes_in, contains_text, sum_present
from cellwise.operators.areas import areas_km2
from cellwise.operators.grid import Grid, country_windows, fine_windows
from cellwise.operators.rasterize import zone_counts
from cellwise.schema import ZONE_KEYS
from cellwise.sources.tables import first_per_key

# The category of plans that count, and the levels counted.
PLAN_CATEGORY = "Humanitarian response plan"
COUNTED_LEVELS = (0, 1, 2)


def active_plans(plans: DataFrame, as_of: date) -> DataFrame:
    """Plans of the category that counts which have not ended."""
    return plans.filter(
        contains_text(F.col("categories"), PLAN_CATEGORY) & (F.col("endDate") >= F.lit(as_of))
    )


def plan_countries(plans: DataFrame) -> DataFrame:
    """Distinct country codes of all plans."""
    return plans.select(F.explode(codes_in(F.col("locations"))).alias("iso3")).distinct()


def max_adm_level(active: Column, source_level: Column) -> Column:
    """Deepest level to compute: 2 with an active plan, else 1, if the source has it."""
    return F.least(F.when(active, 2).otherwise(1), source_level.cast("int"))


def flagged(df: DataFrame, codes: DataFrame, flag: str, column: str = "iso3") -> DataFrame:
    """Add whether a row's code is among ``codes(iso3)``."""
    listed = codes.select(F.col("iso3").alias("_code")).distinct().withColumn("_in", F.lit(True))
    return df.join(listed, F.col(column) == F.col("_code"), "left").withColumn(
        flag, F.col("_in").isNotNull()
    ).drop("_code", "_in")


def pcode_counts(pcodes: DataFrame) -> DataFrame:
    """Codes per country and level, of the counted levels."""
    return (
        pcodes.withColumn("adm_level", F.col("admin_level").cast("int"))
        .filter(F.col("adm_level").isin(*COUNTED_LEVELS))
        .groupBy(F.col("location").alias("iso3"), "adm_level")
        .agg(F.count("pcode").alias("n_pcodes"))
    )


def pcode_columns(counts: DataFrame) -> DataFrame:
    """Counts with one column per level; a country always has one level-0 code."""
    wide = counts.groupBy("iso3").pivot("adm_level", list(COUNTED_LEVELS)).agg(F.sum("n_pcodes"))
    renamed = wide.withColumnsRenamed({str(n): f"adm{n}_pcode_count" for n in COUNTED_LEVELS})
    return renamed.withColumn("adm0_pcode_count", F.lit(1).cast("long"))


def with_total(df: DataFrame) -> DataFrame:
    """Null the level-2 count where level 2 is not computed, and add up the levels."""
    deep = F.when(F.col("max_adm_level") == 2, F.col("adm2_pcode_count"))
    return df.withColumn("adm2_pcode_count", deep).withColumn(
        "total_pcodes", sum_present(*[F.col(f"adm{n}_pcode_count") for n in COUNTED_LEVELS])
    )


def iso3_table(
    boundaries: DataFrame,
    plans: DataFrame,
    pcodes: DataFrame,
    coverage: dict[str, Sequence[str]],
    as_of: date,
    tiebreak: str,
) -> DataFrame:
    """One row per country: source, active plan, deepest level, coverage flags, code counts.

    ``boundaries(iso_3, src_lvl, src_update, o_shp)`` may list a country twice; the first by
    ``tiebreak`` counts. Countries without any counted code drop out.
    """
    base = first_per_key(
        boundaries.select(*dict.fromkeys(["iso_3", "src_lvl", "src_update", "o_shp", tiebreak])),
        ["iso_3"],
        [tiebreak],
    ).withColumnRenamed("iso_3", "iso3")
    base = flagged(base, plan_countries(active_plans(plans, as_of)), "has_active_hrp")
    base = base.withColumn("max_adm_level", max_adm_level(F.col("has_active_hrp"), F.col("src_lvl")))
    base = base.withColumn("stats_last_updated", F.lit(None).cast("date"))
    for dataset, codes in coverage.items():
        base = base.withColumn(dataset, F.col("iso3").isin(*codes))
    joined = with_total(base.join(pcode_columns(pcode_counts(pcodes)), "iso3"))
    return joined.select(
        "iso3",
        "src_update",
        "o_shp",
        "has_active_hrp",
        "max_adm_level",
        "stats_last_updated",
        *coverage,
        *[f"adm{n}_pcode_count" for n in COUNTED_LEVELS],
        "total_pcodes",
    )


@dataclass(frozen=True)
class RasterSource:
    """A dataset's grid, the resolution its statistics use, and its countries if limited."""

    dataset: str
    grid: Grid
    resolution: float | None
    coverage: tuple[str, ...] | None = None


def count_type(source: RasterSource) -> str:
    """``int``, or ``bigint`` where a zone may have more pixels than an int counts."""
    width, height = source.grid.width, source.grid.height
    if source.resolution is not None:
        wide, tall, _ = source.grid.upsampled(source.resolution)
        width, height = max(width, wide), max(height, tall)
    return "int" if width * height < 2**31 else "bigint"


def pixel_counts(zones: DataFrame, source: RasterSource) -> DataFrame:
    """Raw and output pixels per zone: ``n_intersect_raw_pixels, frac_raw_pixels, n_upsampled_pixels``.

    Raw cells are the rows of the zone map, counted on its runs. Zones of a covered country without a pixel count 0; countries outside the grid or the coverage have
    no row.
    Counts are of ``count_type``.
    """
    covered = zones
    if source.coverage is not None:
        covered = zones.filter(F.col("iso3").isin(*source.coverage))
    spans = country_windows(covered, source.grid)
    pixels = zone_counts(covered, spans, source.grid, source.resolution)
    factors = fine_windows(spans, source.grid, source.resolution).select(
        "iso3", (F.col("new_w") / F.col("w")).alias("factor")
    )
    raw, fine = F.coalesce("raw", F.lit(0)), F.coalesce("fine", F.lit(0))
    kind = count_type(source)
    return (
        covered.select(*ZONE_KEYS)
        .join(factors, "iso3")
        .join(pixels, ZONE_KEYS, "left")
        .select(
            *ZONE_KEYS,
            raw.cast(kind).alias("n_intersect_raw_pixels"),
            (fine / (F.col("factor") * F.col("factor"))).alias("frac_raw_pixels"),
            fine.cast(kind).alias("n_upsampled_pixels"),
        )
    )


def polygon_table(zones: DataFrame, sources: Sequence[RasterSource]) -> DataFrame:
    """One row per zone: names, area in square kilometres, and pixel counts per dataset.

    ``zones`` has ``name_language`` next to ``name``; its coordinates are degrees.
    """
    described = zones.select(*ZONE_KEYS, "pcode", "name", "name_language").join(
        areas_km2(zones), ZONE_KEYS, "left"
    )

    def add(table: DataFrame, source: RasterSource) -> DataFrame:
        counts = pixel_counts(zones, source)
        renamed = counts.withColumnsRenamed(
            {c: f"{source.dataset}_{c}" for c in counts.columns if c not in ZONE_KEYS}
        )
        return table.join(renamed, ZONE_KEYS, "left")

    joined = reduce(add, sources, described)
    added = [c for c in joined.columns if c not in described.columns]
    return joined.select(
        "pcode",
        "iso3",
        "adm_level",
        "name",
        "name_language",
        "area",
        F.lit(True).alias("standard"),
        *added,
    )
