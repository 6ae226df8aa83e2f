"""Reads of zone layers, country tables, CSV metadata and stored statistics."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.values import language_of
from cellwise.schema import ZONES

# The form of name columns, how a tag row starts, and the lookup's columns.
NAME_COLUMN = "^ADM{level}_[A-Z]{{2}}$"
TAG_MARK = "#"
LOOKUP_COLUMNS = [
    "ISO3",
    "ADM0_PCODE",
    "ADM0_NAME",
    "ADM1_PCODE",
    "ADM1_NAME",
    "ADM2_PCODE",
    "ADM2_NAME",
    "NAME_LANGUAGE",
    "ADM_LEVEL",
]


def read_zones(
    spark: SparkSession, path: str, iso3s: Sequence[str] | None = None, level: int | None = None
) -> DataFrame:
    """Zone layers, stored by country and level; the filters prune partitions."""
    layers = spark.read.schema(ZONES).parquet(path)
    if iso3s:
        layers = layers.filter(F.col("iso3").isin(list(iso3s)))
    return layers if level is None else layers.filter(F.col("adm_level") == level)


def write_zones(zones: DataFrame, path: str) -> None:
    """Store zone layers so that one country or level can be read alone."""
    zones.repartition("iso3", "adm_level").write.partitionBy("iso3", "adm_level").parquet(path)


def of_countries(table: DataFrame, codes: Sequence[str] | None, column: str = "iso3") -> DataFrame:
    """Rows of the given countries; of all if no codes are given."""
    return table.filter(F.col(column).isin(list(codes))) if codes else table


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order.

    A partial aggregate, not a window: a key with very many rows is reduced before the shuffle.
    """
    return _pick(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the last in the given order."""
    return _pick(df, keys, F.max_by, order)


def _pick(df: DataFrame, keys: Sequence[str], pick, order: Sequence[str | Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("chosen")
    return df.groupBy(*keys).agg(chosen).select(*keys, "chosen.*").select(*df.columns)


def read_tagged_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headered CSV whose tag row (cells starting with ``#``) is dropped, wherever it is."""
    rows = spark.read.csv(path, header=True, schema=schema, multiLine=False)
    return without_tag_row(rows)


def without_tag_row(rows: DataFrame) -> DataFrame:
    texts = [name for name, kind in rows.dtypes if kind == "string"]
    tagged = F.exists(F.array(*texts), lambda c: F.coalesce(c.startswith(TAG_MARK), F.lit(False)))
    return rows.filter(~tagged)


def read_stats(
    spark: SparkSession,
    path: str,
    iso3: str,
    adm_level: int,
    valid_date: date,
    leadtime: int | None = None,
) -> DataFrame:
    """One slice of a country's statistics; the date prunes partitions, the rest is pushed down."""
    table = spark.read.parquet(path)
    return stats_slice(table, iso3, adm_level, valid_date, leadtime)


def stats_slice(
    table: DataFrame, iso3: str, adm_level: int, valid_date: date, leadtime: int | None = None
) -> DataFrame:
    rows = table.filter(
        (F.col("iso3") == iso3)
        & (F.col("adm_level") == adm_level)
        & (F.col("valid_date") == F.lit(valid_date))
    )
    if "month" in table.columns:
        rows = rows.filter(F.col("month") == F.lit(valid_date.replace(day=1)))
    return rows if leadtime is None else rows.filter(F.col("leadtime") == leadtime)


def name_column(columns: Sequence[str], level: int) -> str:
    """The first name column of a layer, whatever its language."""
    form = re.compile(NAME_COLUMN.format(level=level))
    found = [c for c in columns if form.match(c)]
    if not found:
        raise ValueError(f"no name column for level {level} among {list(columns)}")
    return found[0]


def standard_names(layer: DataFrame, level: int) -> DataFrame:
    """A layer's code and name columns as ``pcode``, ``name`` and ``name_language``."""
    name = name_column(layer.columns, level)
    return layer.withColumnsRenamed({f"ADM{level}_PCODE": "pcode", name: "name"}).withColumn(
        "name_language", F.lit(language_of(name))
    )


def lookup_rows(layer: DataFrame, level: int) -> DataFrame:
    """A layer as rows of the code-and-name lookup, columns it lacks left out.

    Names of the levels above are taken in the language of the layer's own name column.
    """
    language = language_of(name_column(layer.columns, level))
    names = {f"ADM{n}_{language}": f"ADM{n}_NAME" for n in range(level + 1)}
    renamed = (
        layer.withColumnsRenamed(names)
        .withColumn("NAME_LANGUAGE", F.lit(language))
        .withColumn("ADM_LEVEL", F.lit(level))
    )
    return renamed.select(*[c for c in LOOKUP_COLUMNS if c in renamed.columns])


def admin_lookup(layers: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """The lookup of all layers; a layer's missing columns are null."""
    rows = [lookup_rows(layer, level) for layer, level in layers]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return together.select(*[c for c in LOOKUP_COLUMNS if c in together.columns])
