"""Sinks. Statistics live in Parquet, partitioned by dataset and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.operators.merge import upsert
from cellwise.schema import QA, DatasetSpec, stats_schema, to_schema
from cellwise.session import small, written

# Rows per insert batch of a database sink.
INSERT_BATCH = 100_000

PARTITIONS = ["dataset", "month"]


def existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table stored at ``path``, if there is one; a folder without a file is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def table_schema(spec: DatasetSpec) -> T.StructType:
    """Columns of the stored statistics, the folders they are partitioned by included."""
    folders = [T.StructField("dataset", T.StringType()), T.StructField("month", T.DateType())]
    return T.StructType([*stats_schema(spec).fields, *folders])


def write_stats(stats: DataFrame, spec: DatasetSpec, path: str) -> None:
    """Upsert a batch of statistics, which may be empty.

    Only the months the batch touches are read and rewritten. The merged months go to the shared
    folder first, as a job may not overwrite what it reads; they then replace the table's in one
    dynamic partition overwrite. Running the same batch again changes nothing.
    """
    spark = stats.sparkSession
    batch = to_schema(stats, stats_schema(spec)).select(
        "*", F.lit(spec.name).alias("dataset"), F.trunc("valid_date", "MM").alias("month")
    )
    batch = written(batch, f"{spec.name}-batch")
    _replace_partitions(batch, path, PARTITIONS, spec.key)


def _replace_partitions(
    batch: DataFrame, path: str, partitions: Sequence[str], key: Sequence[str]
) -> None:
    stored = existing(batch.sparkSession, path, batch.schema)
    if stored is not None:
        # One row per month of a dataset's history, or per country code, whatever the batch's size.
        touched = batch.select(*[F.col(p).alias(f"_{p}") for p in partitions]).distinct()
        same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in partitions]
        kept = stored.join(small(touched, touched.count()), same, "left_semi")
        merged = upsert(kept.select(*batch.columns), batch, [*partitions, *key])
        batch = written(merged, "merged")
    (
        batch.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_polygons(polygons: DataFrame, path: str) -> None:
    """Upsert polygon metadata, stored by country; only the batch's countries are rewritten."""
    _replace_partitions(
        written(polygons, "polygon-batch"), path, ["iso3"], ["pcode", "adm_level"]
    )


def append_qa(rows: DataFrame, path: str) -> None:
    to_schema(rows, QA).write.mode("append").parquet(path)


def write_iso3(table: DataFrame, path: str) -> None:
    """Replace the country table, in order of its codes."""
    table.orderBy("iso3").write.mode("overwrite").parquet(path)


def write_lookup(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = INSERT_BATCH, **options: str) -> None:
    """Append to a database table in batches, for users who serve statistics from one."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch), **options
    ).mode("append").save()
