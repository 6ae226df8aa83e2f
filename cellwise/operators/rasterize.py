"""Polygons to pixels.

Rasterising is relational: edges are exploded over the pixel rows they cross, the crossings
of a zone in a row are paired in order, and each pair becomes a run of pixels. One shuffle,
keyed by the source row, serves every later step. Pixels are unfolded last: which zone has a
pixel, and how many a zone has, is settled on runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.functions.geometry import ring_edges
from cellwise.operators.grid import (
    MAX_WINDOWS, Grid, at_cells, fine_index, fine_windows, in_stretches, source_index, zone_bounds,
)
from cellwise.schema import ZONE_KEYS
from cellwise.session import partitions, small

ROW_KEYS = ["iso3", "adm_level", "band_row", "row"]
# Sorts begin with the output row: its numbers tell most rows of a task apart, codes and levels few.

# What is shuffled by rows is shuffled by bands of them, so that a band can be unfolded by columns.
BAND = 32
BAND_KEYS = ["iso3", "adm_level", "band_row"]

# Unfolding by columns: runs of a band that begin in the same stretch of ``NEAR`` columns go together,
# unless they are ``SHORT`` or more than ``MANY``.
NEAR, SHORT, MANY = 256, 8, 4 * BAND

# Blocks along a side of a zone's bounding box, at most, give or take one.
BLOCKS_ACROSS = 4


def zone_edges(zones: DataFrame, *keys: str) -> DataFrame:
    """Directed edges of all rings of each zone, holes included."""
    keys = keys or tuple(ZONE_KEYS)
    rings = zones.select(*keys, F.explode("rings").alias("ring")).filter(F.size("ring") >= 3)
    return rings.select(*keys, F.inline(ring_edges(F.col("ring"))))


def _dealt_edges(zones: DataFrame, spans: DataFrame, *keys: str) -> DataFrame:
    """Edges with their output window, dealt over tasks: each becomes as many rows as it crosses.

    A layer of many small zones may lie in one file, and so in one task.
    """
    dealt = zone_edges(zones, *keys).repartition(partitions(zones.sparkSession), *keys, "x1", "y1")
    return dealt.join(small(spans, MAX_WINDOWS), "iso3")


def crossing_x(y: Column) -> Column:
    """Where an edge meets the horizontal at ``y``; null for a horizontal edge."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    return x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1)


def _spread_over_rows(edges: DataFrame, touching: bool = False) -> DataFrame:
    """One row per edge and output row it reaches, with that row's centre ``yc``."""
    top = (F.col("fy0") - F.greatest("y1", "y2")) / F.col("fres_y")
    bottom = (F.col("fy0") - F.least("y1", "y2")) / F.col("fres_y")
    shift = 0.0 if touching else 0.5
    return (
        edges.withColumn("_lo", F.greatest(F.floor(top - shift), F.lit(0)).cast("int"))
        .withColumn("_hi", F.least(F.ceil(bottom - shift), F.col("new_h") - 1).cast("int"))
        .filter("_lo <= _hi")
        .withColumn("frow", F.explode(F.sequence("_lo", "_hi")))
        .drop("_lo", "_hi")
        .withColumn("yc", F.col("fy0") - (F.col("frow") + 0.5) * F.col("fres_y"))
    )


def _with_source_row(df: DataFrame) -> DataFrame:
    placed = df.withColumn("row", F.col("r_lo") + source_index(F.col("frow"), F.col("h"), F.col("new_h")))
    return placed.withColumn("band_row", band("row"))


def band(row: str) -> Column:
    return F.expr(f"{row} div {BAND}")


WINDOW_COLUMNS = ["c_lo", "w", "new_w", "fx0", "fres_x"]


def zone_pixels(
    zones: DataFrame, spans: DataFrame, all_touched: bool = False, key: str = "zone_idx"
) -> DataFrame:
    """Output pixels of every zone: ``iso3, adm_level, key, row, frow, fcol`` and window columns.

    ``spans`` are output windows from ``fine_windows``. A pixel belongs to a zone if its centre
    is inside by the even-odd rule over all rings; on an edge, the left side is outside and the
    right side inside. Pixels may repeat where zones overlap.
    """
    keys = ["iso3", "adm_level", key]
    inside = _unfolded(pixel_runs(zones, spans, False, key), keys)
    if not all_touched:
        return inside
    edges = _dealt_edges(zones, spans, *dict.fromkeys([*keys, "zone_idx"]))
    return inside.unionByName(_unfolded(_touched_runs(edges, keys), keys)).distinct()


def _unfolded(runs: DataFrame, keys: list[str]) -> DataFrame:
    pixels = runs.withColumn("fcol", F.explode(F.sequence("lo", "hi")))
    return pixels.select(*keys, "row", "frow", "fcol", *WINDOW_COLUMNS)


def pixel_runs(
    zones: DataFrame, spans: DataFrame, all_touched: bool = False, key: str = "zone_idx"
) -> DataFrame:
    """The same pixels as runs: columns ``lo`` to ``hi`` of an output row, partitioned by source row.

    Runs of different zones may overlap.
    """
    keys = ["iso3", "adm_level", key]
    named = dict.fromkeys([*keys, "zone_idx"])
    edges = _dealt_edges(zones, spans, *named)
    crossings = (
        _with_source_row(_spread_over_rows(edges))
        .filter((F.col("y1") > F.col("yc")) != (F.col("y2") > F.col("yc")))
        .withColumn("xc", crossing_x(F.col("yc")))
    )
    ordered = Window.partitionBy("frow", "zone_idx", *ROW_KEYS).orderBy("xc")
    runs = (
        crossings.select(*named, "band_row", "row", "frow", "xc", *WINDOW_COLUMNS)
        .repartition(partitions(zones.sparkSession), *BAND_KEYS)
        .withColumn("nth", F.row_number().over(ordered))
        .withColumn("until", F.lead("xc").over(ordered))
        .filter("nth % 2 = 1")
    )

    def pixel(x: Column, shift: float) -> Column:
        return F.floor(F.round((x - F.col("fx0")) / F.col("fres_x") + shift, 9)).cast("int")

    inside = _runs_of(runs, pixel(F.col("xc"), 0.5), pixel(F.col("until"), -0.5), keys)
    if not all_touched:
        return inside
    both = inside.unionByName(_touched_runs(edges, keys))
    return _joined_up(both, ["frow", *[k for k in keys if k not in ROW_KEYS], *ROW_KEYS])


def _runs_of(runs: DataFrame, first: Column, last: Column, keys: list[str]) -> DataFrame:
    return (
        runs.withColumn("lo", F.greatest(first, F.lit(0)))
        .withColumn("hi", F.least(last, F.col("new_w") - 1))
        .filter("lo <= hi")
        .select(*keys, "band_row", "row", "frow", "lo", "hi", *WINDOW_COLUMNS)
    )


def _joined_up(runs: DataFrame, line: list[str]) -> DataFrame:
    """Runs of a line that overlap or adjoin as one run."""
    along = Window.partitionBy(*line).orderBy("lo")
    reach = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        runs.withColumn("apart", F.coalesce(F.col("lo") > reach + 1, F.lit(True)).cast("int"))
        .withColumn("island", F.sum("apart").over(upto))
        .groupBy(*line, "island", *WINDOW_COLUMNS)
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("island")
    )


def owned_runs(zones: DataFrame, spans: DataFrame, all_touched: bool = False) -> DataFrame:
    """Runs of output pixels by the zone that has them: where zones overlap, the highest index.

    Runs of a line that touch no other are passed on. Those that overlap in a chain look at each
    other, and each keeps what no higher one that overlaps it takes.
    """
    line = ["frow", *ROW_KEYS]
    along = Window.partitionBy(*line).orderBy("lo", "hi")
    reach = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.struct("lo", "hi", F.coalesce("zone_idx", F.lit(-(2**31))).alias("zone"))
    chained = (
        pixel_runs(zones, spans, all_touched)
        .withColumn("apart", F.coalesce(F.col("lo") > reach, F.lit(True)).cast("int"))
        .withColumn("chain", F.sum("apart").over(upto))
        .withColumn("run", run)
        .withColumn("held", F.collect_list("run").over(Window.partitionBy(*line, "chain")))
    )
    mine = F.col("run")
    above = F.filter(
        "held",
        lambda r: (r["lo"] <= mine["hi"])
        & (r["hi"] >= mine["lo"])
        & ((r["zone"] > mine["zone"]) | ((r["zone"] == mine["zone"]) & (r["lo"] < mine["lo"]))),
    )
    # What is left begins at the run's own begin or after a higher run, where none has the pixel.
    begins = F.array_distinct(F.concat(F.array("lo"), F.transform("above", lambda r: r["hi"] + 1)))
    free = F.filter(
        begins,
        lambda at: (at <= mine["hi"])
        & (at >= mine["lo"])
        & ~F.exists("above", lambda r: (r["lo"] <= at) & (r["hi"] >= at)),
    )

    def until(at: Column) -> Column:
        later = F.array_min(F.transform(F.filter("above", lambda r: r["lo"] > at), lambda r: r["lo"] - 1))
        return F.least(mine["hi"], later)

    whole = F.array(F.struct("lo", "hi"))
    left = F.transform(free, lambda at: F.struct(at.alias("lo"), until(at).alias("hi")))
    return (
        chained.withColumn("above", F.when(F.size("held") > 1, above))
        .withColumn("left", F.when(F.coalesce(F.size("above"), F.lit(0)) < 1, whole).otherwise(left))
        .select(*ZONE_KEYS, "band_row", "row", "frow", *WINDOW_COLUMNS, F.inline("left"))
    )


def _touched_runs(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels a boundary passes through: each edge cut to each pixel row, then a run of columns."""
    spread = _with_source_row(_spread_over_rows(edges, touching=True))
    row_top = F.col("fy0") - F.col("frow") * F.col("fres_y")
    row_bottom = row_top - F.col("fres_y")
    cut = (
        spread.withColumn("ya", F.greatest(F.least("y1", "y2"), row_bottom))
        .withColumn("yb", F.least(F.greatest("y1", "y2"), row_top))
        .filter("ya <= yb")
        .withColumn("xa", F.coalesce(crossing_x(F.col("ya")), F.col("x1")))
        .withColumn("xb", F.coalesce(crossing_x(F.col("yb")), F.col("x2")))
    )

    def pixel(x: Column) -> Column:
        return F.floor((x - F.col("fx0")) / F.col("fres_x")).cast("int")

    return _runs_of(
        cut, pixel(F.least("xa", "xb")), pixel(F.greatest("xa", "xb")), keys
    ).repartition(partitions(edges.sparkSession), *BAND_KEYS)


def zone_map(
    zones: DataFrame,
    spans: DataFrame,
    grid: Grid,
    resolution: float | None = None,
    all_touched: bool = False,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Zone of every source cell: ``iso3, adm_level, zone_idx, row, col, w``.

    ``spans`` are clip windows per country. ``w`` is the number of output pixels of the zone
    that take the cell's value, so weighted statistics over source cells equal plain ones over
    the upsampled raster. Where zones overlap, the highest index has the pixel. With ``cells``
    from ``held_cells``, the map has no other cells, and its work grows with them and with runs.
    """
    owned = owned_runs(zones, fine_windows(spans, grid, resolution), all_touched)
    if resolution is not None:
        return _weighed(owned, cells)
    # Output pixels are the window's own cells here, so no index is turned into another.
    runs = owned.withColumns({"first": F.col("c_lo") + F.col("lo"), "last": F.col("c_lo") + F.col("hi")})
    one = F.lit(1).cast("long").alias("w")
    if cells is None:
        pixels = by_columns(runs, ZONE_KEYS).select(*ZONE_KEYS, "col", F.inline("rows"))
        return pixels.select(*ZONE_KEYS, "row", "col", one)
    return at_cells(runs, cells).select(*ZONE_KEYS, "row", "col", one)


def by_columns(runs: DataFrame, keys: list[str], *fields: str) -> DataFrame:
    """Cells of runs ``(*keys, band_row, row, first, last, *fields)``, as ``(*keys, col, rows)``.

    ``rows`` has a ``row`` with its ``fields`` for each cell that the column has in a band. To follow
    the columns of a band one by one takes no more work than to follow its rows, but leaves the column
    as it is for several cells and the rows coming round, which stored tables pack well.
    """
    held = F.struct("row", "first", "last", *fields)
    named = ["row", *fields]
    stacked = (
        runs.withColumns({"near": F.expr(f"first div {NEAR}"), "long": F.col("last") - F.col("first") >= SHORT})
        .groupBy(*keys, "band_row", "near", "long")
        .agg(F.sort_array(F.collect_list(held)).alias("held"))
    )
    # Between two marks of a stack, where a run begins or is over, the same rows have each column.
    marks = F.array_sort(F.array_distinct(F.flatten(F.transform("held", lambda r: F.array(r["first"], r["last"] + 1)))))

    def at_mark(at: Column, i: Column) -> Column:
        having = F.filter("held", lambda r: (r["first"] <= at) & (r["last"] >= at))
        rows = F.transform(having, lambda r: F.struct(*[r[f].alias(f) for f in named]))
        return F.struct(at.alias("first"), (F.get("marks", i + 1) - 1).alias("last"), rows.alias("rows"))

    alone = lambda r: F.struct(r["first"].alias("first"), r["last"].alias("last"), F.array(F.struct(*[r[f].alias(f) for f in named])).alias("rows"))
    stack = F.col("long") & (F.size("held") > 1) & (F.size("held") <= MANY)
    upright = F.transform(F.slice("marks", F.lit(1), F.size("marks") - 1), at_mark)
    parts = F.when(stack, upright).otherwise(F.transform("held", alone))
    cut = stacked.withColumn("marks", F.when(stack, marks)).select(*keys, F.inline(parts))
    return cut.filter(F.size("rows") > 0).select(*keys, F.explode(F.sequence("first", "last")).alias("col"), "rows")


def _by_cell(owned: DataFrame, cells: DataFrame) -> DataFrame:
    """A row per run and held cell it takes pixels of, with ``n``, how many."""
    met = at_cells(_on_source(owned), cells)
    return met.select(*ZONE_KEYS, "row", "col", run_weight(F.col("col")).alias("n")).filter("n > 0")


def _on_source(owned: DataFrame) -> DataFrame:
    """Runs with the source columns ``first`` to ``last`` whose values their pixels take."""
    source = lambda at: F.col("c_lo") + source_index(F.col(at), F.col("w"), F.col("new_w"))
    return owned.withColumns({"first": source("lo"), "last": source("hi")})


def _taking(col: Column) -> tuple[Column, Column]:
    """First and last output column of the window that take the value of source column ``col``."""
    size, new_size = F.col("w").cast("long"), F.col("new_w").cast("long")
    at = col - F.col("c_lo")
    return fine_index(at, size, new_size), fine_index(at + 1, size, new_size) - 1


def zone_runs(zones: DataFrame, spans: DataFrame, grid: Grid, resolution: float | None = None) -> DataFrame:
    """The zone map by runs: cells ``first`` to ``last`` of a ``row``, within one ``stretch`` of it.

    Its size follows from outlines, not from cells or slices; ``cells_in_zones`` lets the cells meet it.
    With a resolution, there is a run per output row, with what ``run_weight`` needs: a cell meets as
    many runs of a zone as output rows take it. That suits factors of a few; ``zone_map`` adds them up.
    """
    cut = in_stretches(_on_source(owned_runs(zones, fine_windows(spans, grid, resolution))))
    place = [*ZONE_KEYS, "row", "stretch"]
    if resolution is None:
        return cut.select(*place, "first", "last")
    return cut.select(*place, "first", "last", "lo", "hi", "c_lo", "w", "new_w")


def run_weight(col: Column) -> Column:
    """Output pixels of a run that take the value of source column ``col``; below 1: none."""
    begin, end = _taking(col)
    return (F.least(F.col("hi"), end) - F.greatest(F.col("lo"), begin) + 1).cast("long")


def _weighed(owned: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Output pixels counted per zone and source cell."""
    if cells is None:
        return _weighed_runs(owned)
    return (
        _by_cell(owned, cells)
        .groupBy("iso3", "adm_level", "row", "col", "zone_idx")
        .agg(F.sum("n").alias("w"))
        .select(*ZONE_KEYS, "row", "col", "w")
    )


def _weighed_runs(owned: DataFrame) -> DataFrame:
    """The same of all cells, settled on runs: what the runs of a cell have in common is counted once.

    A run has all output columns of its inner source cells and a part of its outer ones. Along a row,
    ``whole`` is the number of runs that have all of a cell, and ``part`` what the others have of it.
    """
    begin, end = F.col("begin"), F.col("end")
    runs = _on_source(owned).withColumns({"begin": _taking(F.col("first"))[0], "end": _taking(F.col("last"))[1]})

    def piece(first: Column, last: Column, whole: Column, part: Column) -> Column:
        part = part.cast("long")
        change = lambda at, sign: F.struct(at.alias("col"), (sign * whole).alias("whole"), (sign * part).alias("part"))
        return F.array(change(first, F.lit(1)), change(last + 1, F.lit(-1)))

    first, last, nothing = F.col("first"), F.col("last"), F.lit(0).cast("long")
    # An outer cell of which the run has every column counts among the inner ones.
    inner_first = F.when(F.col("lo") > begin, first + 1).otherwise(first)
    inner_last = F.when(F.col("hi") < end, last - 1).otherwise(last)
    after_first, before_last = _taking(first)[1], _taking(last)[0]
    none = F.slice(piece(first, first, nothing, nothing), 1, 0)
    left = F.when(F.col("lo") > begin, piece(first, first, nothing, F.least("hi", after_first) - F.col("lo") + 1))
    right = F.when(
        (F.col("hi") < end) & ((last > first) | (F.col("lo") <= begin)),
        piece(last, last, nothing, F.col("hi") - F.greatest("lo", before_last) + 1),
    )
    inner = F.when(inner_first <= inner_last, piece(inner_first, inner_last, F.lit(1).cast("long"), nothing))
    changes = F.concat(*[F.coalesce(p, none) for p in (left, inner, right)])
    place = [*BAND_KEYS, "row", "zone_idx", "c_lo", "w", "new_w"]
    changed = (
        runs.select(*place, F.inline(changes))
        .groupBy(*place, "col")
        .agg(F.sum("whole").alias("whole"), F.sum("part").alias("part"))
    )
    along = Window.partitionBy(*place).orderBy("col")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    even = changed.select(
        *place,
        F.col("col").alias("first"),
        (F.lead("col").over(along) - 1).alias("last"),
        F.sum("whole").over(upto).alias("whole"),
        F.sum("part").over(upto).alias("part"),
    ).filter("whole > 0 OR part > 0")
    window = [*ZONE_KEYS, "c_lo", "w", "new_w"]
    columns = by_columns(even, window, "whole", "part")
    begin, end = _taking(F.col("col"))
    wide = columns.select(*ZONE_KEYS, "col", (end - begin + 1).cast("long").alias("wide"), "rows")
    pixels = wide.select(*ZONE_KEYS, "col", "wide", F.inline("rows"))
    weight = F.col("whole") * F.col("wide") + F.col("part")
    return pixels.select(*ZONE_KEYS, "row", "col", weight.alias("w")).filter("w > 0")


def zone_counts(
    zones: DataFrame, spans: DataFrame, grid: Grid, resolution: float | None = None
) -> DataFrame:
    """Rows (``raw``) and weights (``fine``) of each zone in the zone map, from runs alone."""
    owned = owned_runs(zones, fine_windows(spans, grid, resolution))
    # Upsampled, neighbours share source cells; otherwise each output pixel has its own.
    source = lambda at: F.when(
        F.col("new_w") >= F.col("w"), source_index(F.col(at), F.col("w"), F.col("new_w"))
    ).otherwise(F.col(at))
    along = Window.partitionBy(*ROW_KEYS, "zone_idx").orderBy("first")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("last") - F.greatest(F.col("first") - 1, reach)
    return (
        owned.withColumns({"first": source("lo"), "last": source("hi")})
        .withColumn("new", F.greatest(new, F.lit(0)))
        .groupBy(*ZONE_KEYS)
        .agg(F.sum("new").alias("raw"), F.sum(F.expr("CAST(hi - lo + 1 AS BIGINT)")).alias("fine"))
    )


def zone_map_upsampled_first(
    zones: DataFrame,
    spans: DataFrame,
    grid: Grid,
    resolution: float,
    cells: DataFrame | None = None,
) -> DataFrame:
    """The zone map if the whole raster is upsampled before it is clipped.

    ``spans`` are clip windows on the *output* grid, found with its own cell centres.
    """
    new_w, new_h, _ = grid.upsampled(resolution)
    whole = zones.select("iso3").distinct().selectExpr(
        "iso3",
        "0 AS r_lo",
        f"{grid.height - 1} AS r_hi",
        "0 AS c_lo",
        f"{grid.width - 1} AS c_hi",
        f"{grid.width} AS w",
        f"{grid.height} AS h",
        f"{new_w} AS new_w",
        f"{new_h} AS new_h",
    )
    fine = (
        whole.withColumn("fx0", F.lit(grid.x0))
        .withColumn("fy0", F.lit(grid.y0))
        .withColumn("fres_x", F.lit(grid.width * grid.res / new_w))
        .withColumn("fres_y", F.lit(grid.height * grid.res / new_h))
    )
    clip = spans.selectExpr("iso3", "r_lo AS fr_lo", "r_hi AS fr_hi", "c_lo AS fc_lo", "c_hi AS fc_hi")
    owned = (
        owned_runs(zones, fine)
        .join(small(clip, MAX_WINDOWS), "iso3")
        .filter("frow BETWEEN fr_lo AND fr_hi")
        .withColumns({"lo": F.greatest("lo", "fc_lo"), "hi": F.least("hi", "fc_hi")})
        .filter("lo <= hi")
    )
    return _weighed(owned, cells)


def points_in_zones(points: DataFrame, zones: DataFrame, block: float, *keys: str) -> DataFrame:
    """Zones holding each point ``(*keys, x, y)``, for points that are on no grid.

    A point first meets the zones whose bounding box covers it (equi-join on square blocks), then
    only the edges of those zones in its own horizontal band. It is inside if an odd number of them
    cross its row to its left. Blocks and bands have the side ``block``, doubled until a box or an
    edge reaches over a few of them, so large zones are no more rows than small ones.
    """

    def doublings(extent: Column) -> Column:
        """How often ``block`` is doubled; an extent of 0 has no logarithm."""
        return F.greatest(F.ceil(F.log2(extent / (BLOCKS_ACROSS * block))), F.lit(0)).cast("int")

    def at(place: Column) -> Column:
        return F.floor(place / (F.lit(block) * F.pow(F.lit(2.0), F.col("doubled"))))

    def blocks(low: str, high: str) -> Column:
        return F.explode(F.sequence(at(F.col(low)), at(F.col(high))))

    def sizes(blocked: DataFrame) -> Column:
        """The block sizes in use, some dozens at most."""
        return F.explode(blocked.agg(F.collect_set("doubled")).scalar()).alias("doubled")

    bounds = zone_bounds(zones, *ZONE_KEYS)
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    sized = bounds.withColumn("doubled", doublings(extent))
    boxes = sized.withColumn("block_x", blocks("minx", "maxx")).withColumn(
        "block_y", blocks("miny", "maxy")
    )
    candidates = (
        points.select(*keys, "x", "y", sizes(sized))
        .withColumns({"block_x": at(F.col("x")), "block_y": at(F.col("y"))})
        .join(boxes, ["doubled", "block_x", "block_y"])
        .filter("x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy")
        .select(*keys, "x", "y", *ZONE_KEYS)
    )
    long = (
        zone_edges(zones)
        .withColumns({"lower": F.least("y1", "y2"), "upper": F.greatest("y1", "y2")})
        .withColumn("doubled", doublings(F.col("upper") - F.col("lower")))
    )
    edges = long.withColumn("block_y", blocks("lower", "upper")).drop("lower", "upper")
    candidates = candidates.select("*", sizes(long)).withColumn("block_y", at(F.col("y")))
    crossed = candidates.join(edges, [*ZONE_KEYS, "doubled", "block_y"]).filter(
        ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y")))
        & (crossing_x(F.col("y")) < F.col("x"))
    )
    return (
        crossed.groupBy(*keys, *ZONE_KEYS)
        .agg(F.count(F.lit(1)).alias("crossings"))
        .filter("crossings % 2 = 1")
        .drop("crossings")
    )


def dissolved_pixels(zones: DataFrame, spans: DataFrame, grid: Grid) -> DataFrame:
    """Pixels of all features of a country and level as one zone: their union on the grid.

    Each feature keeps its own even-odd test, so features that overlap do not cancel out.
    """
    runs = _joined_up(pixel_runs(zones, fine_windows(spans, grid, None)), ["frow", *ROW_KEYS])
    placed = runs.withColumns({"first": F.col("c_lo") + F.col("lo"), "last": F.col("c_lo") + F.col("hi")})
    layer = ["iso3", "adm_level"]
    return by_columns(placed, layer).select(*layer, "col", F.inline("rows")).select(*layer, "row", "col")
