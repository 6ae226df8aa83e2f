"""Hard negatives of anchors, by Kronecker-packed products.

Components are whole numbers. Those of several rows are biased to be non-negative and laid into
separate fields of one wide integer, wide enough that no sum of products leaves its field. One
multiplication of an anchor's component by such an integer multiplies the components of all its
rows; added over the dimensions, the fields hold the exact inner products, less the bias. The
width follows from the norms at hand: while the integer fits the 53 whole bits of a double, the
matrix product of a linear algebra library does this work exactly; else Python's integers do, and
the fields may be as wide as they need.

Anchors meet all rows in blocks. A pass over the blocks finds each anchor's positives, of which a
block reports no more than are asked for; a second pass finds, for the scores of those, the best
rows of other labels within the band below each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellwise.session import partitions, small, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative scores at least this percentage of its positive, and at most all of it.
LEAST, MOST = 80, 100
# Rows of a block on either side, at most; small tables are cut finer, one block a task.
BLOCK = 16_384
FINEST = 1_024
DOUBLE_BITS = 53
# Rows packed into one of Python's integers, where a double has no room for two fields.
WIDE_FIELDS = 8
# Anchors multiplied at once: bounds the products held at a time.
CHUNK = 128


class Packed:
    """Rows of whole numbers, packed for products with anchors whose norm is at most ``norm``."""

    def __init__(self, rows: np.ndarray, norm: float) -> None:
        self.n, dim = rows.shape
        self.bias = max(0, -int(rows.min(initial=0)))
        biased = rows + self.bias
        longest = float(np.sqrt((biased.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))
        # |a * c| <= |a| |c|. One more bit holds the sign, another the rounding of the norms.
        self.width = int(np.ceil(np.log2(max(2.0, norm * longest)))) + 2
        self.in_doubles = self.width <= DOUBLE_BITS
        self.fields = DOUBLE_BITS // self.width if self.in_doubles else WIDE_FIELDS
        kind = np.int64 if self.in_doubles else object
        groups = -(-self.n // self.fields)
        padded = np.zeros((groups * self.fields, dim), kind)
        padded[: self.n] = biased
        parts = padded.reshape(groups, self.fields, dim)
        wide = np.zeros((groups, dim), kind)
        for i in range(self.fields):
            wide += parts[:, i] * (1 << self.width * i)
        self.wide = wide.astype(np.float64).T if self.in_doubles else wide.T

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of each anchor (row) with each packed row (column)."""
        middle, mask = 1 << self.width - 1, (1 << self.width) - 1
        # Half a field is added to each, so that none is negative and borrows from the next.
        lift = sum(middle << self.width * i for i in range(self.fields))
        if self.in_doubles:
            sums = (anchors.astype(np.float64) @ self.wide).astype(np.int64) + lift
        else:
            anchors = anchors.astype(object)
            sums = anchors @ self.wide + lift
        found = np.zeros((len(anchors), sums.shape[1], self.fields), sums.dtype)
        for i in range(self.fields):
            found[:, :, i] = sums >> self.width * i & mask
        back = middle + self.bias * anchors.sum(axis=1)
        return (found.reshape(len(anchors), -1)[:, : self.n] - back[:, None]).astype(np.int64)


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(embedding: Column, scale: int = SCALE) -> Column:
    """Whether a vector has finite components only, small enough for its scores to fit a long."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    squares = F.aggregate(embedding, F.lit(0.0), lambda a, x: a + F.pow(F.abs(x.cast("double") * scale) + 1, F.lit(2.0)))
    return embedding.isNotNull() & F.coalesce(F.forall(embedding, finite), F.lit(False)) & (squares < 2.0**62)


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64).reshape(len(column), dim)


def _scores(rows: pd.DataFrame, asks: pd.DataFrame, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place of each anchor, and its products with all rows of the block."""
    anchors = _matrix(asks["q"], dim)
    norm = float(np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1).max()))
    packed = Packed(_matrix(rows["v"], dim), norm)
    for at in range(0, len(anchors), CHUNK):
        for i, scores in enumerate(packed.products(anchors[at : at + CHUNK])):
            yield at + i, scores


def _first(places: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``places`` by falling score, then rising id."""
    if len(places) > k:
        of = scores[places]
        places = places[of >= np.partition(of, len(of) - k)[len(of) - k]]
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """``dim``, and into how many blocks its rows and its anchors are cut; none without anchors."""
    n, asking = F.count("*"), F.count(F.when(F.col("asks"), 1))
    most = partitions(rows.sparkSession)
    counts = rows.groupBy("dim").agg(n.alias("n"), asking.alias("m")).filter("m > 0")
    fine = F.least(F.lit(most), F.ceil(F.col("n") / FINEST))
    return counts.select(
        "dim",
        F.greatest(F.ceil(F.col("n") / block), fine).cast("int").alias("row_blocks"),
        F.ceil(F.col("m") / block).cast("int").alias("ask_blocks"),
    )


def _met(rows: DataFrame, asks: DataFrame, blocks: DataFrame, found, schema: str) -> DataFrame:
    """``found`` of every block of rows and block of anchors of one dimension."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cut = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    left = rows.join(blocks, "dim").withColumn("row_block", cut("row_blocks", "id", "mark"))
    left = left.select("dim", "row_block", every("ask_blocks").alias("ask_block"), "id", "mark", "label", "v")
    right = asks.join(blocks, F.col("d") == F.col("dim")).withColumn("b", cut("ask_blocks", "a", "m"))
    right = right.select("d", every("row_blocks").alias("e"), "b", *asks.drop("d").columns)
    both = left.groupBy("dim", "row_block", "ask_block").cogroup(right.groupBy("d", "e", "b"))
    return both.applyInPandas(found, schema)


def mined(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchors`` says which rows are anchors. An anchor's positives are the ``positives`` best other
    rows of its label; to each of them belong the ``negatives`` best rows of other labels that
    score from ``least`` to ``most`` per cent of it. Better is a higher inner product of the
    ``quantised`` vectors, then the smaller id. Fewer rows give fewer positives or negatives.

    Rows with a null id, a null label or a vector that is not ``usable`` take no part. Rows that
    repeat in id, label and vector are one row; with an id in common only, they are several.
    Vectors of different lengths have no product and don't meet; empty ones score 0. Other columns
    are not read. An empty table gives an empty result.
    """
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label).alias("label"),
        F.col(embedding).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    whole = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    whole = whole.select("id", F.col("label").cast("string").alias("label"), quantised(F.col("v")).alias("v"), "asks").distinct()
    marked = whole.withColumns({"mark": F.xxhash64("label", "v"), "dim": F.size("v")})
    rows = written(marked, "rows")
    blocks = written(_blocks(rows, block), "blocks")
    blocks = small(blocks, blocks.count())
    named = {"dim": "d", "id": "a", "mark": "m", "label": "own", "v": "q"}  # a cogroup takes no name from both sides
    asks = rows.filter("asks").select(*[F.col(old).alias(new) for old, new in named.items()])

    def positive(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = {"id": [], "mark": [], "other": [], "score": []}
        if len(rows) and len(asks):
            ids, marks, labels = rows["id"].to_numpy(), rows["mark"].to_numpy(), rows["label"].to_numpy()
            who = asks[["a", "m", "own"]].to_numpy()
            for i, scores in _scores(rows, asks, int(rows["dim"].iloc[0])):
                at, mark, own = who[i]
                near = np.flatnonzero((labels == own) & ((ids != at) | (marks != mark)))
                best = _first(near, scores, ids, positives)
                for name, values in (("id", [at] * len(best)), ("mark", [mark] * len(best)), ("other", ids[best]), ("score", scores[best])):
                    found[name].extend(values)
        return pd.DataFrame({name: np.array(values, np.int64) for name, values in found.items()})

    first = _met(rows, asks, blocks, positive, "id long, mark long, other long, score long")
    by_score = lambda *of: W.partitionBy(*of).orderBy(F.desc("score"), "other")
    first = first.withColumn("at", F.row_number().over(by_score("id", "mark"))).filter(F.col("at") <= positives)
    first = written(first, "positives")

    def negative(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = {"id": [], "mark": [], "of": [], "other": [], "score": []}
        if len(rows) and len(asks):
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            who, sought = asks[["a", "m", "own"]].to_numpy(), asks["sought"].to_numpy()
            for i, scores in _scores(rows, asks, int(rows["dim"].iloc[0])):
                at, mark, own = who[i]
                bands = [(int(s), -(-least * int(s) // 100), most * int(s) // 100) for s in sought[i]]
                inside = (scores >= min(b[1] for b in bands)) & (scores <= max(b[2] for b in bands))
                near = np.flatnonzero(inside & (labels != own))
                for of, low, high in bands:
                    band = near[(scores[near] >= low) & (scores[near] <= high)]
                    best = _first(band, scores, ids, negatives)
                    n = len(best)
                    for name, values in (("id", [at] * n), ("mark", [mark] * n), ("of", [of] * n), ("other", ids[best]), ("score", scores[best])):
                        found[name].extend(values)
        return pd.DataFrame({name: np.array(values, np.int64) for name, values in found.items()})

    sought = first.groupBy("id", "mark").agg(F.collect_set("score").alias("sought"))
    asking = asks.join(sought, (F.col("id") == F.col("a")) & (F.col("mark") == F.col("m"))).drop("id", "mark")
    second = _met(rows, asking, blocks, negative, "id long, mark long, of long, other long, score long")
    second = second.withColumn("rank", F.row_number().over(by_score("id", "mark", "of"))).filter(F.col("rank") <= negatives)
    pairs = first.select(F.col("id").alias("anchor_id"), F.col("mark").alias("m"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    same = (F.col("id") == F.col("anchor_id")) & (F.col("mark") == F.col("m")) & (F.col("of") == F.col("positive_score"))
    return pairs.join(second, same).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
