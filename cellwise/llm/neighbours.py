"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more coordinate that makes them unit
vectors, so that the largest inner product is the smallest distance. Each of a few tables hashes
a vector by floors of random projections. A query visits, in every table, its own bucket and the
perturbed ones in the order of their estimated success: the squared distance from the query to
the bucket along the projections. A bounded sample fits tables, projections and visits: of those
that reach a recall there, the cheapest for a table of this size. The sample answers nothing.

A bucket is searched where its vectors are: queries come to it, blocks of both meet in one matrix
product. Visits go in stages, the likeliest first; the k-th best score found so far is a bound
for the next stage, so the candidates of a query do not grow with the table. Large buckets are cut
into blocks, so no group grows with the data. Then two kinds of query meet all rows, in blocks:
those whose buckets hold too few candidates, and vectors that ``MANY_ASKERS`` queries share.

Equal vectors are one class. Of a class only the smallest ids can be among anyone's nearest, so a
vector that a third of all rows share is one row of the search.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellwise.session import small, written

# Tables and projections to choose from. A cell has ``KEY_BITS`` bits, shared by the projections.
TABLES = (2, 3, 5)
PROJECTIONS = (2, 3, 4, 5, 6)
KEY_BITS = 60
WIDTH = 1.0
# Perturbations a query may make in all, at most.
MOVES = 1_024
# What a visit costs, in rows compared.
VISIT_ROWS = 64
# Vectors of the sample on which the hashing is fitted; it is gathered on the driver.
SAMPLE = 4_096
SAMPLE_QUERIES = 256
RECALL = 0.96
# Shares of the visits after which the bound is taken anew; the first stage is one visit a table.
STAGES = (0.0, 0.15, 1.0)
# A vector that as many queries share meets all rows besides: what it misses counts for each of them.
# Such vectors are a tenth of the queries at most.
MANY_ASKERS = 10
BLOCK = 8_192
SEED = 11


class Hashing:
    """Projections of all tables, and the perturbations a query may visit."""

    def __init__(self, dim: int, scale: float, tables: int, projections: int, seed: int = SEED) -> None:
        random = np.random.default_rng(seed)
        self.tables, self.projections = tables, projections
        self.axes = random.normal(size=(tables, projections, dim + 1))
        self.offsets = random.uniform(0, WIDTH, size=(tables, projections))
        self.scale, self.visits = scale, 1
        self.reach = max(1, int((MOVES ** (1 / projections) - 1) / 2 + 1e-9))
        self.moves = np.array(list(itertools.product(range(-self.reach, self.reach + 1), repeat=projections)))

    def _places(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.axes[table].T + self.offsets[table]) / WIDTH

    def _packed(self, cells: np.ndarray) -> np.ndarray:
        bits = KEY_BITS // self.projections
        key = np.zeros(cells.shape[:-1], np.int64)
        for k in range(self.projections):
            key = (key << bits) + (cells[..., k].astype(np.int64) + (1 << (bits - 1)))
        return key

    def stored(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Bucket of each vector."""
        scaled = vectors / self.scale
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        return self._packed(np.floor(self._places(np.column_stack([scaled, rest]), table)))

    def visited(self, queries: np.ndarray, table: int, visits: int | None = None) -> np.ndarray:
        """Buckets each query visits, likeliest first."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        places = self._places(np.column_stack([unit, np.zeros(len(unit))]), table)
        base = np.floor(places)
        inner = places - base
        # Squared distance to the near edge of the cell that each move leads to, per projection.
        steps = np.arange(-self.reach, self.reach + 1)
        gap = np.maximum(0.0, np.maximum(steps - inner[..., None], inner[..., None] - steps - 1)) ** 2
        cost = sum(gap[:, k, self.moves[:, k] + self.reach] for k in range(self.projections))
        order = np.argsort(cost, axis=1, kind="stable")[:, : visits or self.visits]
        return self._packed(base[:, None, :] + self.moves[order])


def fitted(sample: np.ndarray, total: int, scale: float, k: int, recall: float) -> Hashing:
    """The cheapest hashing for ``total`` vectors that reaches ``recall`` on the sample.

    Its cost is the rows of the visited buckets plus ``VISIT_ROWS`` a visit. If none reaches the
    recall, the one that comes closest.
    """
    queries = sample[:: max(1, len(sample) // SAMPLE_QUERIES)]
    near = np.argsort(-(queries @ sample.T), axis=1, kind="stable")[:, : k + 1]
    best, best_cost = None, (True, np.inf)
    for projections in PROJECTIONS:
        hashing = Hashing(sample.shape[1], scale, max(TABLES), projections)
        n_moves = len(hashing.moves)
        rank, rows = np.full(near.shape, n_moves), np.zeros(n_moves)
        for table in range(max(TABLES)):
            names, held, counts = np.unique(hashing.stored(sample, table), return_inverse=True, return_counts=True)
            visited = hashing.visited(queries, table, n_moves)
            at = np.minimum(np.searchsorted(names, visited), len(names) - 1)
            known = names[at] == visited
            rows += np.where(known, counts[at], 0).mean(axis=0)
            for i in range(len(queries)):
                nth = np.full(len(names), n_moves)
                nth[at[i][known[i]]] = np.flatnonzero(known[i])
                rank[i] = np.minimum(rank[i], nth[held[near[i]]])
            if table + 1 not in TABLES:
                continue
            reached = np.searchsorted(np.sort(rank.ravel()), np.arange(1, n_moves + 1), side="left") / rank.size
            enough = np.flatnonzero(reached >= recall)
            visits = int(enough[0]) + 1 if len(enough) else n_moves
            work = rows[:visits].sum() / len(sample) * total + VISIT_ROWS * visits * (table + 1)
            cost = (not len(enough), work if len(enough) else -reached[-1])
            if cost < best_cost:
                best, best_cost = Hashing(sample.shape[1], scale, table + 1, projections), cost
                best.visits = visits
    return best


def usable(embedding: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        embedding.isNotNull()
        & (F.size(embedding) > 0)
        & F.coalesce(F.forall(embedding, finite), F.lit(False))
        & F.coalesce(F.exists(embedding, lambda x: x != 0), F.lit(False))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    embedding: str = "embedding",
    recall: float = RECALL,
    hashing: Hashing | None = None,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found of each query.

    ``queries`` says which rows ask; each is compared with all rows but those with its own id.
    Nearness is the inner product in double precision, ties go to the smaller id. Rows with a
    null id or a vector that is not ``usable`` take no part, nor do vectors of another length
    than most have. Repeated rows are one row. An id with several vectors is a candidate, and a
    query, with each of them: it then has a list for each. Fewer candidates than k give fewer
    ranks; an empty table gives none. ``hashing`` replaces the fitted one.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), queries.alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths.d
    hashes = {"class": F.xxhash64("v"), "twin": F.xxhash64(F.lit(SEED), "v")}
    rows = rows.filter(F.size("v") == dim).withColumns(hashes)
    key, ask = ["class", "twin"], ["q_class", "q_twin"]

    # A query's own id takes a place for each of its vectors, so that many more than k are kept.
    ids = written(rows.select(*key, "id").distinct(), "ids")
    keep = k + ids.groupBy("id").count().agg(F.max("count")).first()[0]
    by_id = F.row_number().over(W.partitionBy(*key).orderBy("id"))
    members = written(ids.withColumn("n", by_id).filter(F.col("n") <= keep).drop("n"), "members")
    first = rows.select(*key, "id", "v", by_id.alias("n")).filter("n = 1")
    classes = written(first.select(*key, F.col("id").alias("least"), "v"), "classes")
    asking = written(rows.filter("asks").select(*key, "id").distinct(), "asking")
    asked = classes.join(asking.select(*key).distinct(), key, "left_semi")
    asked = written(asked.select(F.col("class").alias("q_class"), F.col("twin").alias("q_twin"), F.col("v").alias("q")), "asked")

    total, top = classes.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if hashing is None:
        share = int(min(1.0, SAMPLE / total) * (1 << 20)) + 1
        drawn = classes.filter(F.pmod(F.col("class"), F.lit(1 << 20)) < share).orderBy(*key).limit(2 * SAMPLE).collect()
        sample = np.array([r.v for r in drawn]).reshape(-1, dim)
        hashing = fitted(sample if len(sample) else np.ones((1, dim)), total, float(np.sqrt(top)) * (1 + 1e-12), k, recall)
    shared = spark.sparkContext.broadcast(hashing)
    stages = [max(1, round(s * hashing.visits)) for s in STAGES]

    def stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = _matrix(batch["v"]) if len(batch) else np.zeros((0, dim))
            for table in range(shared.value.tables):
                yield batch.assign(table=table, bucket=shared.value.stored(v, table))

    def visited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                v = _matrix(part["q"])
                for table in range(shared.value.tables):
                    buckets = shared.value.visited(v, table)
                    n = buckets.shape[1]
                    nth = np.arange(n)
                    yield pd.DataFrame(
                        {
                            "q_class": np.repeat(part["q_class"].to_numpy(), n),
                            "q_twin": np.repeat(part["q_twin"].to_numpy(), n),
                            "stage": np.tile(np.searchsorted(stages, nth, side="right"), len(part)),
                            "table": table,
                            "bucket": buckets.ravel(),
                        }
                    )

    place = "class long, twin long, least long, v array<double>, table int, bucket long"
    index = written(classes.mapInPandas(stored, place), "index")
    visits = asked.mapInPandas(visited, "q_class long, q_twin long, stage int, table int, bucket long")
    held = written(index.groupBy("table", "bucket").agg(F.count("*").alias("n")), "buckets")
    # A visit to a bucket that nobody is in ends here.
    visits = written(visits.join(small(held.drop("n"), held.count()), ["table", "bucket"], "left_semi"), "visits")

    best = W.partitionBy(*ask).orderBy(F.desc("score"), "least", *key)
    found, bound = None, asked.select(*ask, F.lit(float("-inf")).alias("bound"))
    for stage in range(len(stages)):
        spots = visits.filter(F.col("stage") == stage).drop("stage")
        hits = _searched(index, held, spots, asked.join(bound, ask), keep)
        hits = hits if found is None else hits.unionByName(found)
        merged = hits.groupBy(*ask, *key, "least").agg(F.max("score").alias("score"))
        found = written(merged.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= keep), "found")
        bound = found.groupBy(*ask).agg(F.min(F.when(F.col("n") == keep, F.col("score"))).alias("bound"))
        bound = asked.select(*ask).join(bound, ask, "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        found = found.drop("n")

    # Queries that found too few, or that many ask: all rows, in blocks.
    by_score = F.row_number().over(W.partitionBy(*ask).orderBy(F.desc("score"), "id", *key))
    named = lambda of: of.join(members, key).withColumn("n", by_score).filter(F.col("n") <= keep)
    nearest_ids = written(named(found), "nearest-ids")
    need = min(keep, members.count())
    full = nearest_ids.groupBy(*ask).agg(F.count("*").alias("have")).filter(F.col("have") >= need)
    many = asking.groupBy(*[F.col(c).alias(a) for c, a in zip(key, ask)]).count().filter(F.col("count") >= MANY_ASKERS)
    full = full.join(many, ask, "left_anti")
    short = written(asked.join(full, ask, "left_anti"), "short")
    if not short.isEmpty():
        n_blocks = -(-total // BLOCK)
        block = F.pmod(F.xxhash64(*key), F.lit(n_blocks).cast("long"))
        everywhere = classes.select(*key, "least", "v", F.lit(0).alias("table"), block.alias("bucket"))
        blocks = F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))
        spots = short.select(*ask, F.lit(0).alias("table"), F.explode(blocks).alias("bucket"))
        sizes = everywhere.groupBy("table", "bucket").agg(F.count("*").alias("n"))
        hits = _searched(everywhere, sizes, spots, short.withColumn("bound", F.lit(float("-inf"))), keep)
        kept = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= keep).drop("n")
        nearest_ids = written(nearest_ids.join(full, ask, "left_semi").unionByName(named(kept)), "nearest-ids")

    each = asking.select(F.col("class").alias("q_class"), F.col("twin").alias("q_twin"), F.col("id").alias("query_id"))
    results = each.join(nearest_ids, ask).filter("id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id", *ask).orderBy(F.desc("score"), "id", *key))
    return results.select("query_id", rank.alias("rank"), F.col("id").alias("vec_id"), "score").filter(F.col("rank") <= k)


def _searched(index: DataFrame, held: DataFrame, spots: DataFrame, asked: DataFrame, keep: int) -> DataFrame:
    """Candidates (``q_class``, ``q_twin``, ``class``, ``twin``, ``least``, ``score``) of all visits.

    ``held`` has the rows of each bucket of ``index``; ``asked`` has the vectors ``q`` and bounds of
    the queries of ``spots``. Of each block a query gets the ``keep`` best at its bound or above, and ties.
    """
    spot, key, ask = ["table", "bucket"], ["class", "twin"], ["q_class", "q_twin"]
    sought = spots.groupBy(*spot).agg(F.count("*").alias("m"))
    blocks = held.join(sought, spot).select(
        *spot, F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("m") / BLOCK).cast("int").alias("asks")
    )
    blocks = written(blocks, "blocks")
    blocks = small(blocks, blocks.count())
    cut = lambda n, of: F.pmod(F.xxhash64(F.lit(SEED), *of), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    group = [*spot, "row_block", "ask_block"]
    left = (
        index.join(blocks, spot)
        .withColumn("row_block", cut("rows", key))
        .select(*spot, "row_block", every("asks").alias("ask_block"), *key, "least", "v")
    )
    right = (
        spots.join(blocks, spot)
        .withColumn("ask_block", cut("asks", ask))
        .select(*spot, every("rows").alias("row_block"), "ask_block", *ask)
        .join(asked, ask)
    )

    def searched(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asks):
            v, q = _matrix(rows["v"]), _matrix(asks["q"])
            bound = asks["bound"].to_numpy()
            # Sums in another order differ in their last digits; the exact score is taken below.
            bound = np.where(np.isfinite(bound), bound - 1e-9 * np.abs(bound), bound)
            for at in range(0, len(q), 512):
                scores = q[at : at + 512] @ v.T
                limit = bound[at : at + 512]
                if scores.shape[1] > keep:
                    kth = np.partition(scores, -keep, axis=1)[:, -keep]
                    limit = np.maximum(limit, kth - 1e-9 * np.abs(kth))
                i, j = np.nonzero(scores >= limit[:, None])
                found.append((i + at, j))
        i, j = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in (0, 1))
        columns = {c: asks[c].to_numpy()[i] if len(i) else np.zeros(0, np.int64) for c in ask}
        columns |= {c: rows[c].to_numpy()[j] if len(j) else np.zeros(0, np.int64) for c in [*key, "least"]}
        columns["score"] = (v[j] * q[i]).sum(axis=1) if len(i) else np.zeros(0)
        return pd.DataFrame(columns)

    pair = "q_class long, q_twin long, class long, twin long, least long, score double"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(searched, pair)
