"""Mixing sources to target weights, by Efraimidis-Spirakis sampling.

Each source gets a target number of words. Complete epochs come first: a source whose target is
1.3 times its size has every document once. The rest is sampled without replacement: document d
has the key -ln(u) / quality(d) with u uniform from a hash of its id, and the documents with the
smallest keys are taken until their words reach what is left, each kept if that brings the sum
closer to it.

The order within a source is not a window over the source, which may hold a third of all rows:
keys are cut into slices by their logarithm, slices are added up before the exchange, and only
documents of the slice in which the budget ends are sorted, equal rows as one.

Targets are water levels: every source gets the lesser of weight times level and its cap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellwise.session import small, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
# Slices of a source's keys for each doubling of a key. Whatever the weights, a slice is expected to
# hold at most ln 2 / e / 2048, an eighth of a thousandth of a source: with keys exponential at rate
# w, that is the most of (ln 2 / 2048) key w exp(-w key).
SLICES = 1 << 11
HEX_DIGITS = 13


def word_count(text: Column) -> Column:
    """Number of words that ``WORD`` finds; null: 0."""
    parts = F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD))
    return parts.cast("long")


def uniform(of: Column, seed: str) -> Column:
    """A number in (0, 1) from the md5 of ``of`` and a seed: equal on every rerun."""
    digits = F.conv(F.substring(F.md5(F.concat(of.cast("string"), F.lit(seed))), 1, HEX_DIGITS), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(16**HEX_DIGITS))


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``rank``, counted from 0 by code point, null last; without a global window."""
    spark = sizes.sparkSession
    ranged = sizes.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn(
        "part", F.spark_partition_id()
    )
    ranged = written(ranged, "sources")
    # One row per partition of the exchange above: as many as the session's shuffle partitions.
    counts = ranged.groupBy("part").count()
    before = counts.select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before"))
    in_part = W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    limit = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranged.join(small(before, limit), "part").select(
        "source", "source_size", (F.row_number().over(in_part) - 1 + F.col("before")).alias("rank")
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """``target`` of each row of ``sizes`` (``source``, ``source_size``), one row per source.

    All targets together are ``share`` of all sizes, split by ``weights``, repeating in the order
    of the sources; none is above ``cap`` times its size, and what is cut off goes to the others
    by weight. If every source is at its cap, so are the targets.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked_sources(sizes).withColumn("weight", weight.cast("long")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # The level rises from round to round, and the sources above their caps only grow more.
    capped_size, open_weight = 0, ranked.agg(F.sum("weight")).first()[0] or 0
    level = None
    while open_weight:
        level = (share * total - cap * capped_size) / open_weight
        above = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(cap)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if (row[0], row[1]) == (capped_size, open_weight):
            break
        capped_size, open_weight = row
    most = F.col("source_size") * F.lit(cap)
    target = most if not open_weight else F.least(F.col("weight") * F.lit(level), most)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "-mix",
    quality: DataFrame | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``taken``, ``source``.

    ``taken`` counts the words the mix takes of the document, repeats counted: whole epochs and,
    if the sampling chooses it, once more. ``quality`` has an ``id`` (each once) and its
    positive ``weight``; ids it lacks weigh 1, null or other weights a millionth. Null texts have size 0 and are taken
    0 times; a null source is a source of its own. Ids are drawn by their text, null ids
    by that of the document; rows with equal ids have the same draw and are ordered by size and the
    hash of their text, and of rows that are equal in all this any may be the one that is taken. A source
    of wordless documents only has target 0. Extra columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(text).alias("tie"),
        F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))).alias("name"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        # Joined to sizes, not to texts: a few numbers a row are shuffled.
        known = quality.select(F.col("id").alias("known"), F.coalesce("weight", F.lit(0.0)).alias("weight"))
        rows = rows.join(known, F.col("id") == F.col("known"), "left")
        weight = F.when(F.col("known").isNull(), 1.0).otherwise(F.greatest("weight", F.lit(1e-6)))
    key = -F.ln(uniform(F.col("name"), seed)) / weight
    rows = rows.select("id", "source", "size", "tie", key.alias("key"))
    rows = written(rows.withColumn("slice", F.floor(F.log2("key") * SLICES).cast("int")), "sizes")
    aimed = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    n_sources = aimed.count()
    budgets = aimed.select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    budgets = small(budgets, n_sources)
    same = F.col("source").eqNullSafe(F.col("s"))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("slice"))
    # SLICES rows for each of some fifty doublings meet in this window, however large the source is.
    ends = (
        slices.select("source", "slice", (upto - F.col("words")).alias("before"), upto.alias("upto"))
        .join(budgets, same)
        .filter((F.col("before") <= F.col("rest")) & (F.col("upto") > F.col("rest")))
        .select(F.col("source").alias("s"), F.col("slice").alias("last"), "before")
    )
    known = budgets.join(ends, budgets["s"].eqNullSafe(ends["s"]), "left").select(
        budgets["s"], "source_size", "target", "epochs", "rest", "last", "before"
    )
    known = small(written(known, "budgets"), n_sources)
    placed = rows.join(known, same, "left").drop("s")
    first = placed.filter("last is null or slice != last").withColumn(
        "extra", F.when(F.col("last").isNull(), F.lit(False)).otherwise(F.col("slice") < F.col("last"))
    )
    # Equal rows are one row of the sorted slice, so that copies without an id are no hot group.
    same_rows = ["source", "key", "id", "size", "tie", "source_size", "target", "epochs", "rest", "before"]
    sliced = placed.filter("slice = last").groupBy(*same_rows).agg(F.count("*").alias("copies"))
    order = W.partitionBy("source").orderBy("key", "id", "size", "tie").rowsBetween(W.unboundedPreceding, 0)
    words = F.col("size") * F.col("copies")
    before = F.col("before") + F.sum(words).over(order) - words
    # The n-th copy is taken if before + (n - 1/2) size is within the rest.
    fitting = F.floor((F.col("rest") - before) / F.col("size") + 0.5).cast("long")
    sliced = sliced.withColumn("fitting", F.when(F.col("size") > 0, fitting).otherwise(0))
    sliced = sliced.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    sliced = sliced.withColumn("extra", F.col("nth") <= F.col("fitting"))
    columns = ["id", "source", "size", "source_size", "target", "epochs", "extra"]
    taken = F.col("size") * (F.col("epochs") + F.col("extra").cast("long"))
    return first.select(*columns).unionByName(sliced.select(*columns)).select(
        F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), F.col("source").alias(source)
    )


def label_weights(labels: DataFrame) -> DataFrame:
    """``id`` and ``weight`` of labelled documents: 2 for good, 0.5 for bad; the worst label counts."""
    worst = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    return worst.select(
        F.col("doc_id").alias("id"), F.when(F.col("label") == 1, 2.0).when(F.col("label") == 0, 0.5).otherwise(1.0).alias("weight")
    )
