"""Grids, clipping and nearest-neighbour resampling.

A raster is a table of cells ``(slice keys..., row, col, value)``. Its grid is a handful of
numbers, kept on the driver. Rows count from the top, columns from the left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.session import partitions, small

# The working resolution in degrees.
RESOLUTION = 0.05

# Side of the square blocks of cells used as join keys for rectangle tests.
BLOCK = 64

# Length of the stretches of a row by which runs and single cells find each other.
STRETCH = 1024

# Windows are per country, and a country code has three letters; ``measure`` checks it.
MAX_WINDOWS = 26**3


@dataclass(frozen=True)
class Grid:
    """Origin (upper left corner), cell size and extent of a raster."""

    x0: float
    y0: float
    res: float
    width: int
    height: int

    def x(self, col: Column | str = "col") -> Column:
        return F.lit(self.x0) + (_col(col) + 0.5) * self.res

    def y(self, row: Column | str = "row") -> Column:
        return F.lit(self.y0) - (_col(row) + 0.5) * self.res

    def cell_id(self) -> Column:
        """One number per cell; a bigint, so that no grid is too large for it."""
        return F.col("row").cast("long") * self.width + F.col("col")

    def upsampled(self, resolution: float) -> tuple[int, int, float]:
        """Width, height and factor of this grid at another resolution, truncating."""
        factor = self.res / resolution
        return int(self.width * factor), int(self.height * factor), factor


def _col(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def zone_bounds(zones: DataFrame, *keys: str) -> DataFrame:
    """Bounding box per group of zones (of all of them without keys)."""
    vertices = zones.select(*keys, F.explode("rings").alias("ring")).select(
        *keys, F.inline("ring")
    )
    return vertices.groupBy(*keys).agg(
        F.min("x").alias("minx"),
        F.min("y").alias("miny"),
        F.max("x").alias("maxx"),
        F.max("y").alias("maxy"),
    )


def windows(bounds: DataFrame, grid: Grid) -> DataFrame:
    """Rows and columns of ``grid`` whose centres lie in each box, both ends included.

    Adds ``r_lo, r_hi, c_lo, c_hi``. A box without any centre gives no row.
    """

    def first(distance: Column) -> Column:
        return F.greatest(F.ceil(F.round(distance / grid.res - 0.5, 9)), F.lit(0)).cast("int")

    def last(distance: Column, size: int) -> Column:
        whole = F.floor(F.round(distance / grid.res - 0.5, 9))
        return F.least(whole, F.lit(size - 1)).cast("int")

    keys = [c for c in bounds.columns if c not in ("minx", "miny", "maxx", "maxy")]
    return bounds.select(
        *keys,
        first(F.lit(grid.y0) - F.col("maxy")).alias("r_lo"),
        last(F.lit(grid.y0) - F.col("miny"), grid.height).alias("r_hi"),
        first(F.col("minx") - grid.x0).alias("c_lo"),
        last(F.col("maxx") - grid.x0, grid.width).alias("c_hi"),
    ).filter("r_lo <= r_hi AND c_lo <= c_hi")


@dataclass(frozen=True)
class Sizes:
    """Bounds from the windows alone: source cells in all of them together and in the
    largest, the blocks they touch, and the rows and columns that enclose them all. They decide
    what is broadcast, how medians are taken and which tiles are read.
    """

    cells: int
    largest: int
    blocks: int
    rows: tuple[int, int]
    cols: tuple[int, int]


def measure(spans: DataFrame) -> Sizes:
    rows, cols = F.expr("CAST(r_hi - r_lo + 1 AS BIGINT)"), F.expr("c_hi - c_lo + 1")
    block_rows = F.expr(f"r_hi div {BLOCK} - r_lo div {BLOCK} + 1")
    block_cols = F.expr(f"c_hi div {BLOCK} - c_lo div {BLOCK} + 1")
    found = spans.agg(
        F.count(F.lit(1)),
        F.sum(rows * cols),
        F.max(rows * cols),
        F.sum(block_rows * block_cols),
        F.min("r_lo"),
        F.max("r_hi"),
        F.min("c_lo"),
        F.max("c_hi"),
    ).first()
    if found[0] == 0:
        return Sizes(0, 0, 0, (0, -1), (0, -1))
    n_windows, cells, largest, blocks, *enclosing = [int(v) for v in found]
    if n_windows > MAX_WINDOWS:
        raise ValueError(f"{n_windows} windows; there are at most {MAX_WINDOWS} country codes")
    return Sizes(cells, largest, blocks, tuple(enclosing[:2]), tuple(enclosing[2:]))


def clip(cells: DataFrame, spans: DataFrame, sizes: Sizes, keys: list[str]) -> DataFrame:
    """Cells inside each window, with the window's keys.

    The rectangle test is an equi-join on blocks of cells plus a residual range test, so each
    cell meets only the windows near it.
    """

    def blocks(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.expr(f"{low} div {BLOCK}"), F.expr(f"{high} div {BLOCK}")))

    tiled = spans.withColumn("block_row", blocks("r_lo", "r_hi")).withColumn(
        "block_col", blocks("c_lo", "c_hi")
    )
    located = cells.withColumns(
        {"block_row": F.expr(f"row div {BLOCK}"), "block_col": F.expr(f"col div {BLOCK}")}
    )
    inside = located.join(small(tiled, sizes.blocks), ["block_row", "block_col"]).filter(
        "row BETWEEN r_lo AND r_hi AND col BETWEEN c_lo AND c_hi"
    )
    return inside.select(*keys, *cells.columns)


def stretch(col: str) -> Column:
    """Number of the stretch that a column lies in."""
    return F.expr(f"{col} div {STRETCH}")


def cell_place(grid: Grid) -> tuple[Column, Column]:
    """Row and column of a cell by its number, which is what statistics join on."""
    row, col = (F.call_function(op, grid.cell_id(), F.lit(grid.width).cast("long")) for op in ("div", "mod"))
    return row.cast("int"), col.cast("int")


def in_stretches(runs: DataFrame) -> DataFrame:
    """Each run ``(first, last)`` once for every stretch that it reaches into."""
    return runs.withColumn("stretch", F.explode(F.sequence(stretch("first"), stretch("last"))))


def held_cells(cells: DataFrame, grid: Grid) -> DataFrame:
    """``row, col, stretch`` of the cells that any slice holds, by the number that statistics join on.

    They are dealt by row and stretch, which serves ``at_cells`` too.
    """
    place = [at.alias(name) for at, name in zip(cell_place(grid), ("row", "col"), strict=True)]
    placed = cells.select(*place)
    dealt = placed.withColumn("stretch", stretch("col")).repartition(
        partitions(cells.sparkSession), "row", "stretch"
    )
    return dealt.distinct()


def at_cells(runs: DataFrame, cells: DataFrame) -> DataFrame:
    """Each cell ``(row, col)`` with the runs ``(row, first, last)`` it lies in.

    They meet by stretches of a row, so no key holds more cells than a stretch has. Both sides are
    shuffled: they pack so well that their bytes would pass for a small table.
    """
    cut = in_stretches(runs)
    named = "stretch" if "stretch" in cells.columns else stretch("col").alias("stretch")
    placed = cells.select("row", "col", named)
    return cut.join(placed.hint("merge"), ["row", "stretch"]).filter("col BETWEEN first AND last").drop("stretch")


def in_box(cells: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """Cells whose centre lies in one given box, both ends included."""
    minx, miny, maxx, maxy = box
    return cells.filter(grid.x().between(minx, maxx) & grid.y().between(miny, maxy))


def fine_index(source: Column, size: Column, new_size: Column) -> Column:
    """First output index whose nearest source index is ``source`` or later.

    Output ``j`` takes source ``floor((j + 0.5) * size / new_size)``; solved for ``j`` in whole
    numbers, so no float can tip a tie.
    """
    steps = 2 * source.cast("long") * new_size - size
    return F.when(steps <= 0, F.lit(0)).otherwise(
        F.call_function("div", steps + 2 * size - 1, 2 * size)
    ).cast("int")


def source_index(fine: Column, size: Column, new_size: Column) -> Column:
    """Source index nearest to the centre of output index ``fine``."""
    return F.call_function("div", (2 * fine.cast("long") + 1) * size, 2 * new_size).cast("int")


def _spread(cells: DataFrame, name: str, size: Column, new_size: Column) -> DataFrame:
    """Replace index ``name`` by each output index that takes its value."""
    size, new_size = size.cast("long"), new_size.cast("long")
    following = fine_index(F.col(name) + 1, size, new_size)
    return (
        cells.withColumn("_lo", fine_index(F.col(name), size, new_size))
        .withColumn("_hi", F.least(following, new_size.cast("int")) - 1)
        .filter("_lo <= _hi")
        .withColumn(name, F.explode(F.sequence("_lo", "_hi")))
        .drop("_lo", "_hi")
    )


def upsample(cells: DataFrame, grid: Grid, resolution: float = RESOLUTION) -> DataFrame:
    """Every cell repeated over the output cells that take its value.

    No join: the output rows and columns of a cell follow from its index.
    """
    new_width, new_height, _ = grid.upsampled(resolution)
    tall = _spread(cells, "row", F.lit(grid.height), F.lit(new_height))
    return _spread(tall, "col", F.lit(grid.width), F.lit(new_width))


def prepared(
    cells: DataFrame,
    spans: DataFrame,
    sizes: Sizes,
    grid: Grid,
    resolution: float,
    keys: list[str],
) -> DataFrame:
    """Cells clipped to each window, then upsampled over the clipped extent.

    Rows and columns of the result count from the window's corner. Statistics need no such
    table (they weight source cells instead); this is for users who want the raster itself.
    """
    fine = fine_windows(spans, grid, resolution)
    inner = clip(cells, spans, sizes, keys).join(
        small(fine.select(*keys, "r_lo", "c_lo", "w", "h", "new_w", "new_h"), MAX_WINDOWS), keys
    )
    moved = inner.withColumn("row", F.col("row") - F.col("r_lo")).withColumn(
        "col", F.col("col") - F.col("c_lo")
    )
    tall = _spread(moved, "row", F.col("h"), F.col("new_h"))
    wide = _spread(tall, "col", F.col("w"), F.col("new_w"))
    return wide.drop("r_lo", "c_lo", "w", "h", "new_w", "new_h")


def fine_windows(spans: DataFrame, grid: Grid, resolution: float | None) -> DataFrame:
    """Add the output grid of each window: ``w, h, new_w, new_h, fx0, fy0, fres_x, fres_y``.

    The output covers the clipped extent exactly, so after truncation its cells are not quite
    square. Without a resolution the output grid is the window itself.
    """
    factor = grid.res / resolution if resolution else 1.0
    return (
        spans.withColumn("w", F.expr("c_hi - c_lo + 1"))
        .withColumn("h", F.expr("r_hi - r_lo + 1"))
        .withColumn("new_w", F.floor(F.col("w") * factor).cast("int"))
        .withColumn("new_h", F.floor(F.col("h") * factor).cast("int"))
        .filter("new_w > 0 AND new_h > 0")
        .withColumn("fx0", F.lit(grid.x0) + F.col("c_lo") * grid.res)
        .withColumn("fy0", F.lit(grid.y0) - F.col("r_lo") * grid.res)
        .withColumn("fres_x", F.col("w") * grid.res / F.col("new_w"))
        .withColumn("fres_y", F.col("h") * grid.res / F.col("new_h"))
    )


def country_windows(zones: DataFrame, grid: Grid) -> DataFrame:
    """Clip window of every country: the bounds of its level-0 layer."""
    return windows(zone_bounds(zones.filter("adm_level = 0"), "iso3"), grid)
