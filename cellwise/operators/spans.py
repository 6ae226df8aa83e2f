"""Statistics from running sums: zones as runs of cells, slices as square blocks of cells.

A zone's cells in a row are a few runs. With running sums along the rows of a block, the sum, the
sum of squares and the number of values of a run are differences at its two ends; its least and
greatest value are those of two overlapping stretches whose length is a power of two. So a slice
costs its cells once, to lay them out, and then the runs of the rows it has cells in, however many
cells these hold.

Blocks and runs meet by block number: a task reads a block's runs and then its cells, slice after
slice, so runs are not repeated per slice. A block yields one mergeable row per zone in it, so what
is shuffled after the blocks is zones by blocks, not cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.functions.values import number
from cellwise.operators.grid import Grid
from cellwise.schema import ZONE_KEYS
from cellwise.session import partitions

# Side of a block in cells: short enough for runs to be few in a row of it.
SIDE = 256
STATISTICS = ("mean", "min", "max", "sum", "std", "count")
BLOCK_KEYS = ["block_row", "block_col", "part"]
FIGURES = ("n", "mean", "off", "low", "high")
NO_ZONE = -(2**31)


def zone_runs(zone_map: DataFrame) -> DataFrame:
    """``iso3, adm_level, zone_idx, row, c0, c1, w``: neighbours in a row with equal weight as one.

    ``zone_map`` has cells, or the runs of ``rasterize.zone_runs`` without a resolution.
    """
    if "first" in zone_map.columns:
        return _joined_runs(zone_map)
    along = Window.partitionBy(*ZONE_KEYS, "row", "w").orderBy("col")
    return (
        zone_map.select(*ZONE_KEYS, "row", "col", "w", (F.col("col") - F.row_number().over(along)).alias("shift"))
        .groupBy(*ZONE_KEYS, "row", "w", "shift")
        .agg(F.min("col").alias("c0"), F.max("col").alias("c1"))
        .select(*ZONE_KEYS, "row", "c0", "c1", "w")
    )


def _joined_runs(runs: DataFrame) -> DataFrame:
    """Runs of a zone's own cells, each with the weight 1, that adjoin as one."""
    if "new_w" in runs.columns:
        raise ValueError("the runs of an upsampled zone map have several weights; take its cells")
    place = ["row", *ZONE_KEYS]
    along = Window.partitionBy(*place).orderBy("first")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    apart = F.coalesce(F.col("first") > F.lag("last").over(along) + 1, F.lit(True)).cast("int")
    return (
        runs.withColumn("apart", apart)
        .withColumn("nth", F.sum("apart").over(upto))
        .groupBy(*place, "nth")
        .agg(F.min("first").alias("c0"), F.max("last").alias("c1"))
        .select(*ZONE_KEYS, "row", "c0", "c1", F.lit(1).cast("long").alias("w"))
    )


def runs_by_block(runs: DataFrame, side: int = SIDE) -> DataFrame:
    """Runs cut at the borders of blocks: ``block_row``, ``block_col``, zone keys, ``r``, ``a`` to ``b`` and ``w``."""
    first, last = F.expr(f"c0 div {side}"), F.expr(f"c1 div {side}")
    return runs.withColumn("block_col", F.explode(F.sequence(first, last))).select(
        F.expr(f"row div {side}").alias("block_row"),
        "block_col",
        *ZONE_KEYS,
        (F.col("row") % side).cast("int").alias("r"),
        (F.greatest("c0", F.col("block_col") * side) % side).cast("int").alias("a"),
        (F.least("c1", F.col("block_col") * side + side - 1) % side).cast("int").alias("b"),
        F.col("w").cast("double").alias("w"),
    )


def blocked(cells: DataFrame, slice_keys: Sequence[str], side: int = SIDE) -> DataFrame:
    """Values of each slice by block: ``block_row``, ``block_col``, ``at`` (place in it), ``v``."""
    place = (F.col("row") % side * side + F.col("col") % side).cast("int")
    return cells.select(
        *slice_keys,
        F.expr(f"row div {side}").alias("block_row"),
        F.expr(f"col div {side}").alias("block_col"),
        place.alias("at"),
        number(F.col("value")).cast("double").alias("v"),
    ).filter("v IS NOT NULL")


class Layers:
    """Running sums and stretches of the slices of one block; cells without a value take no place.

    Slices lie below each other: the rows of slice ``k`` are ``k * side`` and on, and ``at`` counts on.
    """

    def __init__(self, at: np.ndarray, v: np.ndarray, side: int) -> None:
        order = np.argsort(at, kind="stable")
        self.at, v, self.side = at[order], v[order], side
        # Per slice, so that no slice's rounding reaches another.
        self.slices, of = np.unique(self.at // (side * side), return_inverse=True)
        self.centre = np.bincount(of, v) / np.bincount(of)
        off = v - self.centre[of]
        self.rows, self.begins, self.held = np.unique(self.at // side, return_index=True, return_counts=True)
        self.s, self.q = self._running(off), self._running(off * off)
        self.low, self.high = self._stretches(v, np.minimum), self._stretches(v, np.maximum)

    def _running(self, x: np.ndarray) -> np.ndarray:
        """Running sums along each row from 0 on, row after row, so row ``i`` begins ``i`` places further."""
        summed = np.zeros(len(x) + len(self.rows))
        # Rows of like lengths at once.
        size = np.frexp(self.held.astype(float))[1]
        for k in np.unique(size):
            of = np.flatnonzero(size == k)
            place = np.arange(self.held[of].max())
            here, held = self.begins[of, None] + place, place < self.held[of, None]
            sums = np.where(held, x[np.minimum(here, len(x) - 1)], 0.0).cumsum(axis=1)
            summed[(here + of[:, None] + 1)[held]] = sums[held]
        return summed

    def _stretches(self, v: np.ndarray, best: np.ufunc) -> list[np.ndarray]:
        """Of level k: the best of the 2^k cells from each cell on."""
        levels, longest = [v], int(self.held.max())
        while 1 << len(levels) <= longest:
            step = 1 << len(levels) - 1
            levels.append(best(levels[-1][:-step], levels[-1][step:]))
        return levels

    @staticmethod
    def _best(levels: list[np.ndarray], best: np.ufunc, begin: np.ndarray, end: np.ndarray, none: float) -> np.ndarray:
        found = np.full(len(begin), none)
        level = np.frexp((end - begin).astype(float))[1] - 1
        for k in np.unique(level[level >= 0]):
            of = level == k
            found[of] = best(levels[k][begin[of]], levels[k][end[of] - (1 << int(k))])
        return found

    def of_zones(self, starts: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
        """Mergeable figures of the zones whose runs begin at ``starts``; those of a zone are of one slice."""
        begin = np.searchsorted(self.at, r * self.side + a)
        end = np.searchsorted(self.at, r * self.side + b, side="right")
        line = np.minimum(np.searchsorted(self.rows, r), len(self.rows) - 1)
        between = lambda x: np.where(end > begin, x[end + line] - x[begin + line], 0.0)
        n, s, q = (np.add.reduceat(w * x, starts) for x in (end - begin, between(self.s), between(self.q)))
        low = np.minimum.reduceat(self._best(self.low, np.minimum, begin, end, np.inf), starts)
        high = np.maximum.reduceat(self._best(self.high, np.maximum, begin, end, -np.inf), starts)
        of = np.minimum(np.searchsorted(self.slices, r[starts] // self.side), len(self.slices) - 1)
        held = np.where(n > 0, n, 1.0)
        # Differences of running sums carry rounding; equal values are known to be equal.
        same = low == high
        return {
            "n": n,
            "mean": np.where(same, low, self.centre[of] + s / held),
            "off": np.where(same, 0.0, np.maximum(0.0, q - s * s / held)),
            "low": low,
            "high": high,
        }


class _Runs:
    """Runs of one block, by row, with a number per zone."""

    def __init__(self, rows: pa.Table, side: int) -> None:
        numbers = lambda name, none=0: pc.fill_null(rows[name], none).to_numpy()
        order = np.argsort(numbers("r"), kind="stable")
        self.names = rows.select(ZONE_KEYS)
        code = pc.dictionary_encode(rows["iso3"].combine_chunks(), null_encoding="encode").indices.to_numpy()
        keys = np.stack([code, *(numbers(k, NO_ZONE) for k in ZONE_KEYS[1:])])
        _, self.one, zone = np.unique(keys, axis=1, return_index=True, return_inverse=True)
        self.zone = zone.reshape(-1)[order]
        self.r, self.a, self.b, self.w = (numbers(k)[order] for k in ("r", "a", "b", "w"))
        self.begins = np.searchsorted(self.r, np.arange(side + 1))

    def figures(self, of: np.ndarray, at: np.ndarray, v: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Slice, a run of the zone, and figures of each zone with a value; ``of`` is a cell's slice."""
        layers = Layers(of.astype(np.int64) * (side * side) + at, v, side)
        # The runs of each row that has cells.
        row = layers.rows % side
        many = self.begins[row + 1] - self.begins[row]
        line = np.repeat(np.arange(len(row)), many)
        run = np.arange(len(line)) - np.repeat(np.cumsum(many) - many, many) + self.begins[row][line]
        key = layers.rows[line] // side * len(self.one) + self.zone[run]
        order = np.argsort(key, kind="stable")
        key, run, r = key[order], run[order], layers.rows[line][order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(starts):
            return key, key, {c: np.zeros(0) for c in FIGURES}
        found = layers.of_zones(starts, r, self.a[run], self.b[run], self.w[run])
        some = found["n"] > 0
        key = key[starts][some]
        return key // len(self.one), self.one[key % len(self.one)], {c: x[some] for c, x in found.items()}


def run_stats(
    cells: DataFrame,
    runs: DataFrame,
    grid: Grid,
    n_runs: int,
    slice_keys: Sequence[str],
    stats: Sequence[str] = STATISTICS,
    side: int = SIDE,
) -> DataFrame:
    """Statistics per slice and zone that has a value, as ``zonal_stats`` gives them.

    ``runs`` come from ``zone_runs`` or ``coverage_runs``; their weights may be fractions, and
    ``count`` is then one too. A cell that a slice repeats counts each time. Runs must lie within
    the grid. ``n_runs`` bounds the rows of ``runs``; no plan depends on it, as nothing is broadcast.
    """
    unknown = [s for s in stats if s not in STATISTICS]
    if unknown:
        raise ValueError(f"running sums give {list(STATISTICS)}, not {unknown}")
    slices, keys = list(slice_keys), [*slice_keys, *ZONE_KEYS]
    kind = runs.schema["w"].dataType
    inside = cells.filter(F.col("row").between(0, grid.height - 1) & F.col("col").between(0, grid.width - 1))
    n_parts = partitions(cells.sparkSession)
    # A grid of fewer blocks than tasks deals out the slices of a block, and its runs go to each part.
    n_blocks = -(-grid.height // side) * -(-grid.width // side)
    shares = -(-n_parts // n_blocks)
    share = F.pmod(F.xxhash64(*slices), F.lit(shares)).cast("int")
    held = blocked(inside, slices, side).select(*slices, "block_row", "block_col", share.alias("part"), "at", "v")
    parts = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("part")
    cut = runs_by_block(runs, side).select("*", parts)
    # A block's runs come first, then its cells, slice by slice.
    both = cut.unionByName(held, allowMissingColumns=True).withColumn("cell", F.col("v").isNotNull())
    dealt = both.repartition(n_parts, *BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS, "cell", *slices)
    fields = {f.name: f for f in [*cells.schema.fields, *runs.schema.fields]}
    schema = T.StructType([fields[k] for k in keys] + [T.StructField(c, T.DoubleType()) for c in FIGURES])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, known = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch[k].to_numpy() for k in BLOCK_KEYS])
            cell = batch["cell"].to_numpy(zero_copy_only=False)
            changed = (np.diff(place, axis=1) != 0).any(axis=0) | np.diff(cell)
            starts = np.concatenate([[0], np.flatnonzero(changed) + 1, [batch.num_rows]])
            for i, j in zip(starts[:-1], starts[1:], strict=True):
                if block != (here := tuple(place[:, i])):
                    block, waiting, known = here, [], None
                rows = batch.slice(i, j - i)
                if not cell[i]:
                    waiting.append(rows)
                    continue
                if waiting:
                    known, waiting = _Runs(pa.Table.from_batches(waiting), side), []
                if known is not None:
                    yield from one_block(rows, known)

    def one_block(rows: pa.RecordBatch, known: _Runs) -> Iterator[pa.RecordBatch]:
        new = np.zeros(rows.num_rows, bool)
        for k in slices:
            code = pc.dictionary_encode(rows[k], null_encoding="encode").indices.to_numpy()
            new[1:] |= np.diff(code) != 0
        first = np.flatnonzero(new | (np.arange(len(new)) == 0))
        of, run, found = known.figures(np.cumsum(new), rows["at"].to_numpy(), rows["v"].to_numpy(), side)
        if len(of):
            named = [rows[k].take(pa.array(first[of])) for k in slices]
            zones = known.names.take(pa.array(run)).combine_chunks()
            named += [zones[k].combine_chunks() for k in ZONE_KEYS]
            yield pa.RecordBatch.from_arrays([*named, *[pa.array(found[c]) for c in FIGURES]], keys + list(FIGURES))

    parts = dealt.mapInArrow(reduced, schema)
    merged = parts.groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.sum(F.col("n") * F.col("mean")).alias("sum"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        # One entry per block that the zone meets: the grid bounds them, not the number of slices.
        F.collect_list(F.struct("n", "mean", "off")).alias("parts"),
    )
    mean = F.greatest(F.least(F.col("sum") / F.col("count"), F.col("max")), F.col("min"))
    merged = merged.withColumn("mean", mean)
    apart = lambda p: p["off"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))
    off = F.aggregate("parts", F.lit(0.0), lambda a, p: a + apart(p))
    merged = merged.withColumn("std", F.sqrt(off / F.col("count"))).withColumn("count", F.col("count").cast(kind))
    return merged.select(*keys, *stats)
