"""Upsert of statistics, and the comparison of result tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions.values import any_of, percent_difference


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` with ``incoming`` laid over it: same key, all columns replaced.

    Nulls in a key are equal to each other. ``incoming`` holds a key at most once. Only its key
    columns are joined, so a small batch is broadcast (Spark checks its size) and the large
    table is neither shuffled nor sorted.
    """
    keys = incoming.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return existing.join(keys, same, "left_anti").unionByName(incoming)


def compare(
    tables: dict[str, DataFrame],
    base: str,
    key: Sequence[str],
    stats: Sequence[str],
    threshold: float = 5.0,
) -> DataFrame:
    """Rows where a statistic of another table is off the base by more than ``threshold`` percent.

    Columns carry their table's name as a suffix. The largest difference comes first.
    """
    renamed = {
        name: df.select(*key, *[F.col(s).alias(f"{s}_{name}") for s in stats])
        for name, df in tables.items()
    }
    joined = renamed[base]
    others = [name for name in tables if name != base]
    for name in others:
        joined = joined.join(renamed[name], list(key))
    differences = {
        f"{s}_diff_{base}_{name}": percent_difference(F.col(f"{s}_{name}"), F.col(f"{s}_{base}"))
        for name in others
        for s in stats
    }
    named = [F.col(c) for c in differences]
    largest = F.greatest(*named) if len(named) > 1 else named[0]
    return (
        joined.withColumns(differences)
        .filter(any_of([c > threshold for c in named]))
        .withColumn("max_difference", largest)
        .orderBy(F.desc("max_difference"), *key)
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, to check that a comparison is of like with like."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
