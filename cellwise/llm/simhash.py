"""SimHash near duplicates, exact, by vantage-point trees over fingerprints.

Every text gets a 64-bit fingerprint. Distinct fingerprints are partitioned by Hamming distance:
a tree of vantage points, fitted on a bounded sample, sends each fingerprint to one leaf. Two
fingerprints at distance t or less differ in their distance to any vantage point by t or less,
so a fingerprint also visits the leaves whose ring it may reach; where two ways part, only the
farther side visits the nearer one, as one meeting is enough. In a leaf, fingerprints are ringed
around the leaf's own vantage point and only rings within t of each other are compared. A leaf
reports the links of a spanning forest, not all pairs.

Linked fingerprints become components; no text is ever shuffled, and a fingerprint that a third
of all documents share is one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.components import components
from cellwise.session import small, written

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2
# The tree is fitted on at most this many fingerprints, chosen evenly by hash.
SAMPLE = 40_000
# Fingerprints a leaf is to hold; a larger one is searched in blocks of as many.
LEAF = 4_096
# Fingerprints a task takes from a leaf at once, of homes and of guests.
MOST = 1 << 18


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned fingerprint per text: a bit is 1 if over half of the shingle hashes have it.

    Null and wordless texts have fingerprint zero.
    """
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), dtype=np.uint64)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        grams = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
        ones = np.zeros(BITS, dtype=np.int64)
        for start in range(0, len(grams), 1 << 16):
            part = grams[start : start + (1 << 16)]
            hashes = np.fromiter((xxh64_intdigest(g, SEED) for g in part), dtype="<u8", count=len(part))
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[i] = weights[2 * ones > len(grams)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text, with ``fp``: the fingerprint as a signed long."""

    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints_of(texts.tolist(), shingle).view(np.int64))

    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.pandas_udf(hashed, "long")(F.col(text)).alias("fp"))


# The tree: arrays of nodes. Node n has children 2n+1 (distance <= radius) and 2n+2.


class Tree:
    """Vantage points and radii of the inner nodes; ``depth`` levels of them."""

    def __init__(self, points: np.ndarray, radii: np.ndarray, depth: int) -> None:
        self.points, self.radii, self.depth = points, radii, depth

    @staticmethod
    def fit(sample: np.ndarray, total: int, leaf: int) -> Tree:
        """Split ``sample`` at median distances until a leaf would hold ``leaf`` of ``total``."""
        depth = 0
        while total / (1 << depth) > leaf and len(sample) / (1 << depth) > 16:
            depth += 1
        nodes = (1 << depth) - 1
        points, radii = np.zeros(max(nodes, 1), np.uint64), np.full(max(nodes, 1), BITS, np.int64)
        members = {0: sample}
        for node in range(nodes):
            mine = members.pop(node)
            if len(mine):
                # The point whose distances spread widest has the fewest at the boundary.
                tried = mine[:: max(1, len(mine) // 8)][:8]
                spread = [np.bitwise_count(mine ^ p).std() for p in tried]
                points[node] = tried[int(np.argmax(spread))]
                far = np.bitwise_count(mine ^ points[node])
                radii[node] = int(np.median(far))
                near = far <= radii[node]
            else:
                near = np.zeros(0, bool)
            members[2 * node + 1], members[2 * node + 2] = mine[near], mine[~near]
        return Tree(points, radii, depth)

    def route(self, fps: np.ndarray, t: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(leaf, index into ``fps``, is home) for the homes and then for the visits."""
        index = np.arange(len(fps))
        home = np.zeros(len(fps), np.int64)
        visits = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for _ in range(self.depth):
            at, who = visits
            far, radius = np.bitwise_count(fps[who] ^ self.points[at]).astype(np.int64), self.radii[at]
            low, high = far - t <= radius, far + t > radius
            moved = (np.concatenate([2 * at[low] + 1, 2 * at[high] + 2]), np.concatenate([who[low], who[high]]))
            far, radius = np.bitwise_count(fps ^ self.points[home]).astype(np.int64), self.radii[home]
            beyond = far > radius
            crossing = beyond & (far - t <= radius)
            visits = (np.concatenate([moved[0], 2 * home[crossing] + 1]), np.concatenate([moved[1], index[crossing]]))
            home = 2 * home + 1 + beyond
        yield home, index, True
        yield *visits, False


class Forest:
    """Sets of positions; ``joined`` has the pairs that joined two of them."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.joined: list[tuple[int, int]] = []

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        """Join the sets of x[i] and y[i] for all i; only pairs of different sets cost time."""
        while True:
            a, b = self.label[x], self.label[y]
            apart = np.flatnonzero(a != b)
            if not len(apart):
                return
            # One pair for each higher set, so that no set is hung below two others at once.
            high = np.maximum(a, b)[apart]
            _, first = np.unique(high, return_index=True)
            at = apart[first]
            self.joined.extend(zip(x[at].tolist(), y[at].tolist()))
            parent = np.arange(len(self.label))
            parent[np.maximum(a[at], b[at])] = np.minimum(a[at], b[at])
            while not np.array_equal(up := parent[parent], parent):
                parent = up
            self.label = parent[self.label]


def leaf_links(
    fps: np.ndarray, at_home: np.ndarray, t: int, block: int = LEAF, within: bool = True
) -> list[tuple[int, int]]:
    """Pairs of positions that link everything within ``t`` in this leaf, home with anyone.

    Without ``within``, only homes with guests.
    """
    homes, guests = np.flatnonzero(at_home), np.flatnonzero(~at_home)
    forest = Forest(len(fps))
    if not len(homes):
        return []
    point = fps[homes[0]]

    def rings(who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.bitwise_count(fps[who] ^ point).astype(np.int64)
        order = np.argsort(far, kind="stable")
        return who[order], np.searchsorted(far[order], np.arange(BITS + 2 + t))

    ringed, start = rings(homes)
    for others, same in ((homes, True), (guests, False))[0 if within else 1 :]:
        mine, own = rings(others)
        for ring in range(BITS + 1):
            row = mine[own[ring] : own[ring + 1]]
            if not len(row):
                continue
            # Triangle bound: partners are in rings ring-t .. ring+t; homes look forward only.
            column = ringed[start[ring if same else max(0, ring - t)] : start[min(BITS + 1, ring + t + 1)]]
            for r in range(0, len(row), 512):
                for c in range(0, len(column), block):
                    x, y = row[r : r + 512], column[c : c + block]
                    i, j = np.nonzero(np.bitwise_count(fps[x][:, None] ^ fps[y][None, :]) <= t)
                    forest.link(x[i], y[j])
    return forest.joined


def links(distinct: DataFrame, distance: int = DISTANCE, leaf: int = LEAF, most: int = MOST) -> DataFrame:
    """Links (``x``, ``y``) that connect all fingerprints of column ``fp`` within ``distance``.

    ``distinct`` has each fingerprint once and is a stored table. A leaf that holds over ``most``
    fingerprints, as the sample is too small for a deeper tree or many are close, is searched by
    pairs of blocks, so that no task holds more than two blocks.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    share = min(1.0, SAMPLE / max(1, total))
    sampled = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = np.array(sorted(r.fp for r in sampled.select("fp").limit(2 * SAMPLE).collect()), np.int64)
    tree = spark.sparkContext.broadcast(Tree.fit(sample.view(np.uint64), total, leaf))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for at in range(0, len(fps), 1 << 13):
                part = fps[at : at + (1 << 13)]
                for shard, who, is_home in tree.value.route(part.view(np.uint64), distance):
                    yield pd.DataFrame({"leaf": shard, "fp": part[who], "home": is_home})

    def searched(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy(np.int64)
        found = leaf_links(fps.view(np.uint64), group["home"].to_numpy(bool), distance, within=key[1] == key[2])
        x, y = ([p[k] for p in found] for k in (0, 1))
        return pd.DataFrame({"x": fps[x], "y": fps[y]}, dtype="int64")

    shards = written(distinct.select("fp").mapInPandas(routed, "leaf long, fp long, home boolean"), "leaves")
    held = shards.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    cut = held.select("leaf", F.ceil(F.col("n") / most).cast("int").alias("blocks"))
    # At most as many rows as the tree has leaves.
    shards = shards.join(small(cut, 1 << tree.value.depth), "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block, each = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    # Homes of block i meet all guests, and the homes of the blocks after theirs as guests.
    shards = shards.withColumn("own", block)
    homes = shards.filter("home").select("leaf", F.col("own").alias("i"), F.explode(each).alias("j"), "fp", "home")
    guests = shards.select(
        "leaf",
        F.explode(F.when(F.col("home"), F.filter(each, lambda i: i < F.col("own"))).otherwise(each)).alias("i"),
        F.col("own").alias("j"),
        "fp",
        F.lit(False).alias("home"),
    )
    return homes.unionByName(guests).groupBy("leaf", "i", "j").applyInPandas(searched, "x long, y long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of ``distance`` or fewer bits, the
    row's own included. Null and wordless texts have fingerprint zero and are linked like any
    other. Repeated rows and rows that share an id are each returned; a null id is never the
    smallest one, and a component of null ids only has a null ``component_id``.
    """
    found = written(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))), "fingerprints")
    of = _components_of(found, distance)
    # The smallest id of a component: a small table of components, added up before its exchange.
    named = of.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = of.join(named, "component").select("fp", "component_id")
    return found.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _components_of(found: DataFrame, distance: int) -> DataFrame:
    """``fp``, its smallest id as ``least``, and ``component`` (a fingerprint) for every ``fp`` of ``found``."""
    distinct = written(found.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    joined = written(components(links(distinct, distance), "x", "y"), "components")
    return distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: one with its smallest id, a null id last.

    Of several rows of a component with that id, the one with the least hash of its text stays
    (null counts as empty), and of rows that share both, one. Other components with the same id,
    null included, keep their own rows.
    """
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keys = docs.select(F.col(id_col).alias("id"), own.alias("hash"), F.col(text).alias("text"))
    found = written(fingerprints(keys), "fingerprints")
    counted = found.groupBy("fp", "id", "hash").agg(F.count("*").alias("rows"))
    of = _components_of(found, DISTANCE).select("fp", "component")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "rows")
    first = counted.join(of, "fp").groupBy("component").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash"), F.col("first.rows").alias("_rows"))
    first = written(first, "kept")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (own == F.col("_hash"))
    kept = docs.join(small(first, first.count()), same)
    columns = docs.columns
    # Rows of one id and text differ in other columns at most; those with a map have no hash.
    others = [F.col(f.name) for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    least = F.min_by(F.struct(*columns), F.xxhash64(*others, *[c.isNull() for c in others]))
    several = kept.filter("_rows > 1").groupBy("_id", "_hash").agg(least.alias("_one")).select("_one.*")
    return kept.filter("_rows = 1").select(*columns).union(several)
