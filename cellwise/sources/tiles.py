"""Raster tiles: one row per tile, its values a row-major array."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.functions.dates import date_in_name
from cellwise.functions.values import number
from cellwise.operators.grid import Grid, Sizes
from cellwise.schema import TILES, DatasetSpec
from cellwise.session import small

# Attributes a tile must carry, by kind of dataset.
REQUIRED_ATTRIBUTES = {
    "daily": ["year_valid", "month_valid", "date_valid"],
    "monthly": ["year_valid", "month_valid"],
    "forecast": ["year_valid", "month_valid", "leadtime"],
}
# Names of the flood-extent bands.
BAND_NAMES = {1: "SFED"}
OTHER_BAND = "MFED"

# Rows and columns of a stored block of a raster, and of the squares in which boxes are compared.
BLOCK = 256
SQUARE = 1024
# Tiles count as aligned if they are so to this part of a cell.
ALIGNED = 1e-3


def kind_of(spec: DatasetSpec) -> str:
    if spec.forecast:
        return "forecast"
    return "monthly" if spec.frequency == "M" else "daily"


def in_blocks(tiles: DataFrame, side: int = BLOCK) -> DataFrame:
    """Tiles cut into blocks of at most ``side`` rows and columns, each a tile of its own.

    Row-wise array functions do it; what a scan reads and a task unfolds is then bounded, and
    the box of each block prunes it.
    """

    def starts(size: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(size) - 1, F.lit(side)))

    cut = tiles.withColumn("_top", starts("height")).withColumn("_left", starts("width"))
    cut = cut.withColumn("_height", F.least(F.lit(side), F.col("height") - F.col("_top")))
    cut = cut.withColumn("_width", F.least(F.lit(side), F.col("width") - F.col("_left")))
    rows = F.sequence(F.col("_top"), F.col("_top") + F.col("_height") - 1)
    # Under a name of its own: inside of the lambda, the select's new ``width`` would be taken.
    part = lambda r: F.slice("data", r * F.col("width") + F.col("_left") + 1, F.col("_width"))
    cut = cut.withColumn("_data", F.flatten(F.transform(rows, part)))
    changed = {
        "x0": F.col("x0") + F.col("_left") * F.col("res"),
        "y0": F.col("y0") - F.col("_top") * F.col("res"),
        "width": F.col("_width"),
        "height": F.col("_height"),
        "data": F.col("_data"),
    }
    return cut.select(*[changed.get(c, F.col(c)).alias(c) for c in tiles.columns])


def write_tiles(tiles: DataFrame, path: str, block: int | None = BLOCK) -> None:
    """Store tiles by dataset and by month of the date in their file name, cut into blocks."""
    parts = tiles if block is None else in_blocks(tiles, block)
    dated = parts.withColumn("file_month", F.trunc(date_in_name(F.col("path")), "MM"))
    dated.write.mode("append").partitionBy("dataset", "file_month").parquet(path)


def read_tiles(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Tiles below ``path``; with ``dataset``, only its folder is read."""
    schema = T.StructType([*TILES.fields, T.StructField("file_month", T.DateType())])
    tiles = spark.read.schema(schema).parquet(path)
    return tiles.filter(F.col("dataset") == dataset) if dataset else tiles


def tiles_of_dates(tiles: DataFrame, prefix: str, plan: DataFrame) -> DataFrame:
    """Tiles under a prefix whose file date is planned, with the plan's other columns.

    A plan is a calendar, some ten thousand rows at most: it is broadcast, and its months become
    a filter on folders, so that an update does not open the archive.
    """
    named = tiles.filter(F.col("path").startswith(prefix)).withColumn(
        "file_date", date_in_name(F.col("path"))
    )
    if "file_month" in tiles.columns:
        months = plan.select(F.trunc("valid_date", "MM").alias("month")).distinct().collect()
        unsorted = F.col("file_month").isNull()
        named = named.filter(F.col("file_month").isin([r.month for r in months]) | unsorted)
    dates = small(plan.withColumnRenamed("valid_date", "file_date"), plan.count())
    return named.join(dates, "file_date")


def tiles_near(tiles: DataFrame, sizes: Sizes, grid: Grid) -> DataFrame:
    """Tiles that reach into the rows and columns enclosing all windows; a filter on the scan."""
    top, bottom = grid.y0 - sizes.rows[0] * grid.res, grid.y0 - (sizes.rows[1] + 1) * grid.res
    left, right = grid.x0 + sizes.cols[0] * grid.res, grid.x0 + (sizes.cols[1] + 1) * grid.res
    return tiles.filter(
        (F.col("x0") < right)
        & (F.col("y0") > bottom)
        & (F.col("x0") + F.col("width") * F.col("res") > left)
        & (F.col("y0") - F.col("height") * F.col("res") < top)
    )


def with_valid_date(tiles: DataFrame, kind: str, extra: Sequence[str] = ()) -> DataFrame:
    """Add ``valid_date`` from the attributes and ``missing``, the attributes a tile lacks.

    ``extra`` are further attributes that the dataset needs, such as its band.

    Monthly and forecast tiles are dated on the first of the month. A tile with something
    missing has no date; ``missing_attributes`` reports it.
    """
    needed = [*REQUIRED_ATTRIBUTES[kind], *[c for c in extra if c not in REQUIRED_ATTRIBUTES[kind]]]
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed]))
    day = F.col("date_valid") if kind == "daily" else F.lit(1)
    return tiles.withColumn("missing", absent).withColumn(
        "valid_date",
        F.when(F.size("missing") == 0, F.make_date("year_valid", "month_valid", day)),
    )


def missing_attributes(dated: DataFrame) -> DataFrame:
    """One row per tile that cannot be dated, naming what it lacks."""
    return dated.filter(F.size("missing") > 0).select(
        "path", F.concat_ws(",", "missing").alias("missing")
    )


def tiles_to_cells(tiles: DataFrame, keys: Sequence[str], grid: Grid | None = None) -> DataFrame:
    """Unfold tiles into cells ``(*keys, row, col, value)``.

    With ``grid``, rows and columns count from the grid's corner, so that a raster may be stored
    as many tiles, and a cell outside of it is an error: its number would be another cell's.
    Without a grid they count from the tile's own corner.
    """
    cells = tiles.select(
        *keys, "x0", "y0", "res", "width", F.posexplode("data").alias("pos", "raw")
    )
    row, col = F.expr("pos div width"), F.col("pos") % F.col("width")
    if grid is not None:
        row = row + F.round((F.lit(grid.y0) - F.col("y0")) / grid.res)
        col = col + F.round((F.col("x0") - grid.x0) / grid.res)
        on_grid = row.between(0, grid.height - 1) & col.between(0, grid.width - 1)
        off = F.raise_error(F.lit("a tile reaches beyond the grid"))
        row = F.when(on_grid, row).otherwise(off.cast("double"))
    return cells.select(
        *keys,
        row.cast("int").alias("row"),
        col.cast("int").alias("col"),
        number(F.col("raw").cast("double")).alias("value"),
    )


def with_centres(cells: DataFrame, grid: Grid) -> DataFrame:
    """Add the centre coordinates of each cell."""
    return cells.withColumn("x", grid.x()).withColumn("y", grid.y())


def tile_grids(tiles: DataFrame) -> DataFrame:
    """Grid of each dataset: the extent of all its tiles together, from their few numbers.

    ``even`` says whether the tiles have one resolution and lie whole cells apart.
    """
    right, bottom = (
        F.col("x0") + F.col("width") * F.col("res"),
        F.col("y0") - F.col("height") * F.col("res"),
    )
    extent = tiles.groupBy("dataset").agg(
        F.min("x0").alias("gx0"),
        F.max("y0").alias("gy0"),
        F.min("res").alias("gres"),
        F.max(right).alias("right"),
        F.min(bottom).alias("bottom"),
    )

    def whole(steps: Column) -> Column:
        return F.abs(steps - F.round(steps)) < ALIGNED

    off_x, off_y = (F.col("x0") - F.col("gx0")) / F.col("gres"), (F.col("gy0") - F.col("y0")) / F.col("gres")
    even = (F.abs(F.col("res") - F.col("gres")) < ALIGNED * F.col("gres")) & whole(off_x) & whole(off_y)
    # One row per dataset, of which the registry has a handful.
    placed = tiles.select("dataset", "x0", "y0", "res").join(extent, "dataset")
    checked = placed.groupBy("dataset").agg(F.bool_and(even).alias("even"))
    size = lambda span: F.round(span / F.col("gres")).cast("int")
    return extent.join(checked, "dataset").select(
        "dataset",
        F.col("gx0").alias("x0"),
        F.col("gy0").alias("y0"),
        F.col("gres").alias("res"),
        size(F.col("right") - F.col("gx0")).alias("width"),
        size(F.col("gy0") - F.col("bottom")).alias("height"),
        "even",
    )


def grid_of(tiles: DataFrame) -> Grid:
    """The grid of a one-dataset tiles table: all its rasters lie on it."""
    row = tile_grids(tiles).first()
    if row is None:
        raise ValueError("no tiles to take a grid from")
    if not row["even"]:
        raise ValueError("tiles differ in resolution or lie parts of a cell apart")
    return Grid(row["x0"], row["y0"], row["res"], row["width"], row["height"])


def conflicting_slices(tiles: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Slices in which two tiles share a cell, as ``(*keys, n_tiles)``: it would count twice.

    Only slices of several tiles are looked at. Equal boxes are counted first; the distinct
    boxes of a slice are compared where they meet, in coarse squares of the grid, so that a
    slice of many blocks is never compared with itself as a whole.
    """
    top, left = (
        F.round((F.lit(grid.y0) - F.col("y0")) / grid.res).cast("long"),
        F.round((F.col("x0") - grid.x0) / grid.res).cast("long"),
    )
    boxes = tiles.groupBy(
        *keys, top.alias("r0"), left.alias("c0"), F.col("height").cast("long").alias("h"), F.col("width").cast("long").alias("w")
    ).agg(F.count(F.lit(1)).alias("n"))
    per_slice = boxes.groupBy(*keys).agg(F.sum("n").alias("n_tiles"), F.max("n").alias("most"), F.count(F.lit(1)).alias("n_boxes"))
    renamed = [F.col(k).alias(f"_{k}") for k in keys]
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    several = per_slice.filter("most = 1 AND n_boxes > 1").select(*renamed)

    def squares(first: str, size: str) -> Column:
        return F.explode(F.sequence(F.expr(f"{first} div {SQUARE}"), F.expr(f"({first} + {size} - 1) div {SQUARE}")))

    near = (
        boxes.join(several, same, "left_semi")
        .withColumn("square_row", squares("r0", "h"))
        .withColumn("square_col", squares("c0", "w"))
        .groupBy(*keys, "square_row", "square_col")
        .agg(F.array_sort(F.collect_list(F.struct("r0", "c0", "h", "w"))).alias("b"))
        .filter(F.size("b") > 1)
    )
    # In a square, boxes are in order of their rows; two share a cell if both ranges meet.
    overlapping = F.exists(
        "b",
        lambda x: F.exists(
            "b",
            lambda y: (x < y)
            & (y["r0"] < x["r0"] + x["h"])
            & (y["c0"] < x["c0"] + x["w"])
            & (x["c0"] < y["c0"] + y["w"]),
        ),
    )
    partly = near.filter(overlapping).select(*renamed).distinct()
    twice = per_slice.filter("most > 1").select(*keys, "n_tiles")
    return twice.unionByName(per_slice.join(partly, same, "left_semi").select(*keys, "n_tiles"))


def without_slices(tiles: DataFrame, slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tiles of all other slices; null keys are equal."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return tiles.join(slices.select(*[F.col(k).alias(f"_{k}") for k in keys]), same, "left_anti")


def band_name(band: Column) -> Column:
    named = [(F.lit(k), F.lit(v)) for k, v in BAND_NAMES.items()]
    return reduce(lambda acc, kv: F.when(band == kv[0], kv[1]).otherwise(acc), named, F.lit(OTHER_BAND))


def stack(parts: Iterable[DataFrame]) -> DataFrame:
    """Cells of several files as one table; a combination no file has is simply absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
