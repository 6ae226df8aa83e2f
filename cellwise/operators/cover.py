"""A quadtree cover of zones, for points that are on no grid.

A zone is covered by squares. One without any edge in it is all inside or all outside; the inside
ones decide their points by an equi-join alone. A square that edges pass is cut in four, until few
edges are left in it; its points test those. So a point costs the same, whatever its zone's outline.

Whether a square's lower left corner is inside follows from its parent's corner: walk up the
parent's left side, then to the right, and count the edges crossed. All of them pass the parent, so
no step looks at any other edge; and a point's own test is the same walk from its square's corner.

Each round of cuts reads the edges of the squares cut before it, in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.operators.grid import zone_bounds
from cellwise.operators.rasterize import zone_edges
from cellwise.schema import ZONE_KEYS
from cellwise.session import removed, small, written

FEW_EDGES = 8
# Squares are cut no further than to this fraction of the whole, 2^-DEEPEST: where more edges than
# FEW_EDGES meet in one vertex, no cut parts them.
DEEPEST = 24
# Squares should not lie on the vertices of gridded zones, so their own origin and size are odd.
STRETCH, OFFSET = 1.0617, 0.0271828
SQUARE = ["level", "qx", "qy"]
EDGE = ["x1", "y1", "x2", "y2"]


@dataclass(frozen=True)
class Cover:
    """``leaves``: squares with their zone, ``inside`` of the corner, and ``edges`` (none: all inside)."""

    leaves: DataFrame
    x0: float
    y0: float
    size: float
    levels: list[int]
    n_leaves: int


def _walked(edge: dict[str, Column], x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """How often the way from (x0, y0) up to ``y`` and then across to ``x`` crosses an edge."""
    x1, y1, x2, y2 = (edge[c] for c in EDGE)
    height = y1 + F.try_divide((x0 - x1) * (y2 - y1), x2 - x1)
    up = ((x1 > x0) != (x2 > x0)) & ((height <= y0) != (height <= y))
    reach = x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1)
    across = ((y1 > y) != (y2 > y)) & ((reach < x0) != (reach < x))
    return F.coalesce(up, F.lit(False)).cast("int") + F.coalesce(across, F.lit(False)).cast("int")


def _touches(x0: Column, y0: Column, side: Column) -> Column:
    """Whether an edge meets the closed square with this corner: boxes overlap, and the corners
    are not all on one side of its line."""
    x1, y1, x2, y2 = (F.col(c) for c in EDGE)
    boxes = (F.least(x1, x2) <= x0 + side) & (F.greatest(x1, x2) >= x0) & (F.least(y1, y2) <= y0 + side) & (F.greatest(y1, y2) >= y0)
    sides = [(x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1) for cx in (x0, x0 + side) for cy in (y0, y0 + side)]
    return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _cut(open_: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """Edges of open squares (``qx, qy``: their lower left quarter at ``level``) by quarter."""
    side = F.lit(size) / F.pow(F.lit(2.0), F.col("level"))
    left, low = F.lit(x0) + F.col("qx") * side, F.lit(y0) + F.col("qy") * side
    edge = {c: F.col(c) for c in EDGE}

    def quarter(dx: int, dy: int) -> Column:
        x, y = F.lit(x0) + (F.col("qx") + dx) * side, F.lit(y0) + (F.col("qy") + dy) * side
        crossed = _walked(edge, left, low, x, y)
        return F.struct(
            (F.col("qx") + dx).alias("qx"), (F.col("qy") + dy).alias("qy"), crossed.alias("crossed"), _touches(x, y, side).alias("touches")
        )

    four = F.array(*[quarter(dx, dy) for dx in (0, 1) for dy in (0, 1)])
    return open_.select(*ZONE_KEYS, "level", "inside", *EDGE, F.explode(four).alias("q")).select(
        *ZONE_KEYS, "level", "q.qx", "q.qy", "inside", "q.crossed", "q.touches", *EDGE
    )


def zone_cover(zones: DataFrame, few_edges: int = FEW_EDGES, deepest: int = DEEPEST) -> Cover:
    """The cover of all zones; those without an edge have no squares. Repeated zone keys are one zone.

    Zones begin with the four squares of about their own size, so small ones take few rounds.
    """
    spark = zones.sparkSession
    edges = zone_edges(zones)
    box = zone_bounds(zones.filter("rings IS NOT NULL")).first()
    if box is None or box.minx is None:
        nothing = edges.limit(0).select(F.lit(0).alias("level"), F.lit(0).cast("long").alias("qx"), F.lit(0).cast("long").alias("qy"), *ZONE_KEYS)
        empty = nothing.withColumns({"inside": F.lit(True), "edges": F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")})
        return Cover(empty, 0.0, 0.0, 1.0, [0], 0)
    size = (max(box.maxx - box.minx, box.maxy - box.miny) or 1.0) * STRETCH
    x0, y0 = box.minx - OFFSET * size, box.miny - OFFSET * size
    own = edges.groupBy(*ZONE_KEYS).agg(
        F.min(F.least("x1", "x2")).alias("minx"),
        F.min(F.least("y1", "y2")).alias("miny"),
        F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("extent"),
    )
    level = F.floor(F.log2(F.lit(size) / F.greatest("extent", F.lit(size / 2.0**deepest))))
    own = own.withColumn("level", F.least(F.greatest(level, F.lit(0)), F.lit(deepest)).cast("int"))
    side = F.lit(size) / F.pow(F.lit(2.0), F.col("level"))
    own = own.select(
        *ZONE_KEYS, "level", F.floor((F.col("minx") - x0) / side).alias("qx"), F.floor((F.col("miny") - y0) / side).alias("qy")
    )
    open_ = edges.join(own, ZONE_KEYS).withColumn("inside", F.lit(False))
    kept, levels = [], set()
    key = [*ZONE_KEYS, *SQUARE]
    while True:
        parts = written(_cut(open_, x0, y0, size), "cover-cut")
        squares = parts.groupBy(*key, "inside").agg(F.sum("crossed").alias("crossed"), F.count(F.when(F.col("touches"), 1)).alias("n"))
        squares = written(
            squares.select(*key, (F.col("inside") != (F.col("crossed") % 2 == 1)).alias("inside"), "n").filter("n > 0 OR inside"), "cover-squares"
        )
        deep = (F.col("n") > few_edges) & (F.col("level") < deepest)
        state = squares.agg(F.count(F.lit(1)), F.count(F.when(deep, 1)), F.collect_set(F.when(~deep, F.col("level")))).first()
        levels.update(state[2])
        named = small(squares.select(*key, F.col("inside").alias("corner"), "n"), state[0])
        held = parts.filter("touches").select(*key, *EDGE).join(named, key)
        done = held.filter(~deep).groupBy(*key).agg(F.first("corner").alias("inside"), F.collect_list(F.struct(*EDGE)).alias("edges"))
        whole = squares.filter("n = 0").select(*key, "inside", F.array().cast(done.schema["edges"].dataType).alias("edges"))
        kept.append(written(done.unionByName(whole), "cover"))
        if not state[1]:
            removed(parts)
            break
        following = held.filter(deep).select(
            *ZONE_KEYS, (F.col("level") + 1).alias("level"), (2 * F.col("qx")).alias("qx"), (2 * F.col("qy")).alias("qy"), F.col("corner").alias("inside"), *EDGE
        )
        open_ = written(following, "cover-open")
        removed(parts)
    leaves = reduce(DataFrame.unionByName, kept)
    return Cover(leaves.select(*SQUARE, *ZONE_KEYS, "inside", "edges"), x0, y0, size, sorted(levels), leaves.count())


def points_in_cover(points: DataFrame, cover: Cover, *keys: str) -> DataFrame:
    """Zones holding each point ``(*keys, x, y)``, as ``points_in_zones`` gives them.

    A point looks up one square per level of the cover. Points with a null or endless coordinate are
    in no zone; other columns are not read.
    """

    def square(level: int) -> Column:
        side = cover.size / 2.0**level
        return F.struct(
            F.lit(level).alias("level"),
            F.floor((F.col("x") - cover.x0) / side).alias("qx"),
            F.floor((F.col("y") - cover.y0) / side).alias("qy"),
        )

    here = points.select(*keys, "x", "y", F.inline(F.array(*[square(k) for k in cover.levels])))
    met = here.join(small(cover.leaves, cover.n_leaves), SQUARE)
    side = F.lit(cover.size) / F.pow(F.lit(2.0), F.col("level"))
    left, low = F.lit(cover.x0) + F.col("qx") * side, F.lit(cover.y0) + F.col("qy") * side
    crossed = F.aggregate(
        "edges", F.lit(0), lambda a, e: a + _walked({c: e[c] for c in EDGE}, left, low, F.col("x"), F.col("y"))
    )
    return met.filter(F.col("inside") != (crossed % 2 == 1)).select(*keys, *ZONE_KEYS)
