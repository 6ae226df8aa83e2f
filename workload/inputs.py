"""Rasters, zones and job tables derived from the given tables.

Everything grows with the tables. The raster of a scale has one row and one column per
supplier (``side``); its zones are five countries, one zone per nation and one per supplier.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.operators.grid import Grid, country_windows, measure
from cellwise.schema import RINGS
from cellwise.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def side(spark: SparkSession, sf_dir: str) -> int:
    """Suppliers of this scale, from the file footers."""
    return table(spark, sf_dir, "supplier").count()


def grid_of_side(n: int) -> Grid:
    return Grid(x0=0.0, y0=float(n), res=1.0, width=n, height=n)


def iso3_of(region: Column) -> Column:
    return F.concat(F.lit("R"), F.char((region + 65).cast("long")), F.lit("X"))


def lattice(n: int) -> tuple[float, int, float]:
    """Width of a country's strip, supplier zones per lattice row, and their pitch."""
    strip = n / 5.0
    across = math.ceil(math.sqrt(n / 25.0))
    return strip, across, strip / across


def _ring(ox: Column, oy: Column, scale: float, shape: list[tuple[float, float]]) -> Column:
    return F.array(
        *[F.struct((ox + dx * scale).alias("x"), (oy + dy * scale).alias("y")) for dx, dy in shape]
    )


COUNTRY = [(0.02, 0.05), (0.98, 0.05), (0.98, 4.95), (0.02, 4.95)]
PENTAGON = [(0.03, 0.03), (0.97, 0.03), (0.97, 0.41), (0.52, 0.96), (0.03, 0.41)]
HOLE = [(0.31, 0.11), (0.31, 0.33), (0.63, 0.33), (0.63, 0.11)]
SPECK = [(0.6, 0.6), (0.9, 0.6), (0.9, 0.9), (0.6, 0.9)]
KITE = [(0.05, 0.07), (0.93, 0.11), (0.88, 0.95), (0.09, 0.83)]


def zones(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Zones of levels 0 (regions), 1 (nations) and 2 (suppliers).

    Nation 0 has a hole. Nations 15 to 19 reach down into their neighbour below (the higher
    index wins there). Nation 24 is a speck that holds no cell centre.
    """
    strip, across, pitch = lattice(n)
    key = F.col("n_nationkey")
    row = F.expr("n_nationkey div 5")
    ox, oy = F.col("n_regionkey") * F.lit(strip), row * F.lit(strip)
    moved = oy - F.when(row == 3, F.lit(0.5 * strip)).otherwise(F.lit(0.0))
    outer = F.when(key == 24, _ring(ox, oy, 1.0, SPECK)).otherwise(
        _ring(ox, moved, strip, PENTAGON)
    )
    nations = table(spark, sf_dir, "nation").select(
        iso3_of(F.col("n_regionkey")).alias("iso3"),
        F.lit(1).alias("adm_level"),
        row.cast("int").alias("zone_idx"),
        F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("pcode"),
        F.col("n_name").alias("name"),
        F.when(key == 0, F.array(outer, _ring(ox, oy, strip, HOLE)))
        .otherwise(F.array(outer))
        .cast(RINGS)
        .alias("rings"),
    )
    region = F.col("r_regionkey")
    regions = table(spark, sf_dir, "region").select(
        iso3_of(region).alias("iso3"),
        F.lit(0).alias("adm_level"),
        F.lit(0).alias("zone_idx"),
        F.concat(F.lit("R"), region.cast("string")).alias("pcode"),
        F.col("r_name").alias("name"),
        F.array(_ring(region * F.lit(strip), F.lit(0.0), strip, COUNTRY)).cast(RINGS).alias("rings"),
    )
    s = F.col("s_suppkey")
    j = F.expr("s_suppkey div 5")
    sx = (s % 5) * F.lit(strip) + (j % across) * F.lit(pitch)
    sy = F.expr(f"(s_suppkey div 5) div {across}") * F.lit(pitch)
    suppliers = table(spark, sf_dir, "supplier").select(
        iso3_of(s % 5).alias("iso3"),
        F.lit(2).alias("adm_level"),
        j.cast("int").alias("zone_idx"),
        F.concat(F.lit("S"), s.cast("string")).alias("pcode"),
        F.col("s_name").alias("name"),
        F.array(_ring(sx, sy, pitch, KITE)).cast(RINGS).alias("rings"),
    )
    return regions.unionByName(nations).unionByName(suppliers)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country table: every second region has an active plan and goes down to level 2."""
    region = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        iso3_of(region).alias("iso3"),
        F.when(region % 2 == 1, 2).otherwise(1).alias("max_adm_level"),
    )


def down_to_deepest(zone_table: DataFrame, country_table: DataFrame) -> DataFrame:
    """Zones down to each country's deepest level."""
    joined = zone_table.join(country_table, "iso3").filter("adm_level <= max_adm_level")
    return joined.select(*zone_table.columns)


def _from_lineitem(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    keys = [
        F.trunc("l_shipdate", "MM").alias("valid_date"),
        *extra,
        F.col("l_suppkey").cast("int").alias("row"),
        F.expr("CAST(l_partkey div 20 AS INT)").alias("col"),
    ]
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(*keys)
        .agg(F.max("l_quantity").alias("value"))
    )


def cells_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cells with leadtimes 0 to 6; about one cell in a hundred is present."""
    return _from_lineitem(spark, sf_dir, (F.col("l_linenumber") - 1).alias("leadtime"))


def cells_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_lineitem(spark, sf_dir)


def cells_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly cells with one in seven missing."""
    gone = F.when((F.col("row") + F.col("col")) % 7 == 0, F.lit(float("nan")))
    return cells_obs(spark, sf_dir).withColumn("value", gone.otherwise(F.col("value")))


def cells_patchy(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Forecast cells where one country in five has no value at all in a slice."""
    strip = n // 5
    blank = (F.expr(f"col div {strip}") + F.month("valid_date") + F.col("leadtime")) % 5 == 0
    value = F.when(blank, F.lit(float("nan"))).otherwise(F.col("value"))
    return cells_forecast(spark, sf_dir).withColumn("value", value)


def cells_band(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Daily cells in two bands, from the events."""
    band = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(2)
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.to_date("ts").alias("valid_date"),
            band.alias("band"),
            F.expr(f"CAST(event_id % {n} AS INT)").alias("row"),
            F.expr(f"CAST(user_id % {n} AS INT)").alias("col"),
        )
        .agg(F.max("value").alias("value"))
    )


TILE_SIDE = 8


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 8 x 8 tile per embedding, on consecutive days. Some lack an attribute."""
    made = tiles_from(table(spark, sf_dir, "embeddings"))
    return made.withColumn(
        "date_valid", F.when(F.col("vec_id") % 10 != 9, F.col("date_valid"))
    ).withColumn("leadtime", F.when(F.col("vec_id") % 8 != 7, F.col("leadtime")))


def tiles_from(embeddings: DataFrame) -> DataFrame:
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("vec_id").cast("int"))
    return embeddings.select(
        "vec_id",
        day.alias("day"),
        F.lit("embeddings").alias("dataset"),
        F.concat(F.lit("tiles/t_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".tif")).alias("path"),
        F.year(day).alias("year_valid"),
        F.month(day).alias("month_valid"),
        F.dayofmonth(day).alias("date_valid"),
        (F.col("label") % 7).alias("leadtime"),
        F.lit(0.0).alias("x0"),
        F.lit(float(TILE_SIDE)).alias("y0"),
        F.lit(1.0).alias("res"),
        F.lit(TILE_SIDE).alias("width"),
        F.lit(TILE_SIDE).alias("height"),
        F.col("embedding").cast("array<double>").alias("data"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names with their issue date and leadtime; every 50th has no date."""
    day = F.when(F.col("o_orderkey") % 50 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.when(F.col("o_orderkey") % 3 == 0, F.lit("monthly/")).otherwise(F.lit("daily/")),
            F.lit("processed/p_"),
            F.coalesce(day, F.lit("latest")),
            F.lit("_lt"),
            (F.col("o_orderkey") % 7).cast("string"),
            F.lit(".tif"),
        ).alias("path")
    )


class Scene:
    """Grid, stored zone layers and clip windows of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.side = side(spark, sf_dir)
        self.grid = grid_of_side(self.side)
        self.zones = written(zones(spark, sf_dir, self.side), "zones")
        self.in_use = down_to_deepest(self.zones, countries(spark, sf_dir))
        self.windows = written(country_windows(self.zones, self.grid), "windows")
        self.sizes = measure(self.windows)
        self.n_zones = self.zones.count()

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Scene:
        """The scene, stored once per session: zone layers are tables, not part of a query."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _SCENES:
            _SCENES[key] = cls(spark, sf_dir)
        return _SCENES[key]

    def level(self, adm_level: int) -> DataFrame:
        return self.zones.filter(F.col("adm_level") == adm_level)


_SCENES: dict[tuple[str, str], Scene] = {}


# Job tables


def code(k: Column) -> Column:
    """A three-letter code for a number; codes repeat after 26^3 numbers."""

    def letter(step: int) -> Column:
        return F.char((F.floor(k / step) % 26 + 65).cast("long"))

    return F.concat(letter(676), letter(26), letter(1))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary metadata, two rows per country."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        code(F.expr("s_suppkey div 2")).alias("iso_3"),
        (F.col("s_nationkey") % 4).alias("src_lvl"),
        F.date_add(F.lit("2020-01-01").cast("date"), (s % 1000).cast("int")).alias("src_update"),
        F.concat(F.lit("shp/"), F.col("s_name")).alias("o_shp"),
        s.alias("listed"),
    )


def plans(spark: SparkSession, sf_dir: str, n_codes: int) -> DataFrame:
    """Response plans, one per order."""
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", F.lit("Humanitarian response plan"))
        .when(priority == "2-HIGH", F.lit("Flash appeal; humanitarian RESPONSE plan (2)"))
        .when(priority != "3-MEDIUM", F.lit("Regional refugee plan"))
        .alias("categories"),
        F.to_date("o_orderdate").alias("endDate"),
        F.concat(
            code(F.col("o_custkey") % n_codes),
            F.lit(" | "),
            code(F.col("o_orderkey") % n_codes),
            F.lit("|"),
        ).alias("locations"),
    )


def pcodes(spark: SparkSession, sf_dir: str, n_codes: int) -> DataFrame:
    """Global code list, one per customer; some rows lack the code itself."""
    return table(spark, sf_dir, "customer").select(
        code(F.col("c_custkey") % (n_codes + 3)).alias("location"),
        (F.col("c_nationkey") % 5).cast("string").alias("admin_level"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).alias("pcode"),
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage lists: the market segments as datasets, their customers' codes as countries."""
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_mktsegment").alias("dataset"), code(F.col("c_custkey")).alias("iso3"))
        .distinct()
    )


def stats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast statistics, one row per line item; about one in a thousand breaks a rule."""
    q = F.col("l_quantity")
    kind = F.when(F.col("l_partkey") % 997 == 0, F.col("l_suppkey") % 12).otherwise(-1)
    month = F.trunc("l_shipdate", "MM")
    lead = F.col("l_linenumber") - 1

    def spoilt(n: int, bad: Column, good: Column) -> Column:
        return F.when(kind == n, bad).otherwise(good)

    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf_dir, "lineitem").select(
        spoilt(6, F.lit("1AA"), code(F.col("l_suppkey"))).alias("iso3"),
        F.concat_ws("-", *[F.col(p).cast("string") for p in parts]).alias("pcode"),
        month.alias("valid_date"),
        spoilt(7, F.add_months(month, 9), F.add_months(month, spoilt(9, -lead - 1, -lead))).alias(
            "issued_date"
        ),
        spoilt(8, F.lit(9), lead).alias("leadtime"),
        spoilt(5, F.lit(5), F.col("l_linenumber") % 3).alias("adm_level"),
        spoilt(1, q + 11, q + 5).alias("mean"),
        spoilt(2, q - 1, q + 4).alias("median"),
        spoilt(11, F.lit(None).cast("double"), q).alias("min"),
        spoilt(0, q - 1, q + 10).alias("max"),
        spoilt(4, F.lit(-1), F.lit(7)).alias("count"),
        (q * 7).alias("sum"),
        spoilt(3, F.lit(-1.0), F.lit(1.5)).alias("std"),
    )


def keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as statistics with a two-part key, the second part null for line 7."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string")).alias("pcode"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("leadtime"),
        F.col("l_quantity").alias("mean"),
        F.col("l_returnflag").alias("flag"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("seq"),
    )


def in_degrees(zone_table: DataFrame, n: int) -> DataFrame:
    """Zones scaled from the grid onto 160 degrees each way around (0, 0)."""
    scale = F.lit(160.0 / n)

    def point(p: Column) -> Column:
        return F.struct((p["x"] * scale - 80).alias("x"), (p["y"] * scale - 80).alias("y"))

    return zone_table.withColumn(
        "rings", F.transform("rings", lambda ring: F.transform(ring, point))
    )


def grid_in_degrees(n: int, per_cell: int = 1) -> Grid:
    return Grid(-80.0, 80.0, 160.0 / n / per_cell, n * per_cell, n * per_cell)


def borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed line per nation, one vertex per customer."""
    n = table(spark, sf_dir, "customer").count()
    angle = F.col("c_custkey") * F.lit(2 * math.pi / n)
    radius = F.lit(1.0) + F.col("c_acctbal") / 50_000
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.col("c_custkey").alias("pos"),
        (radius * F.cos(angle)).alias("x"),
        (radius * F.sin(angle)).alias("y"),
    )
