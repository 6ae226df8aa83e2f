"""The catalogue of raster files: which dates exist, which files a run needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.dates import date_in_name


def file_catalog(paths: DataFrame) -> DataFrame:
    """Add ``file_date`` to a table of paths; files without a date in their name are left out."""
    return paths.withColumn("file_date", date_in_name(F.col("path"))).filter("file_date IS NOT NULL")


def undated_files(paths: DataFrame) -> DataFrame:
    """The files ``file_catalog`` leaves out."""
    return paths.filter(date_in_name(F.col("path")).isNull())


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all files below a folder; the listing is distributed, contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    )
    return found.select("path")


def select_files(catalog: DataFrame, prefix: str, dates: DataFrame) -> DataFrame:
    """Files under a prefix whose date is among ``dates(valid_date)``."""
    wanted = dates.select(F.col("valid_date").alias("file_date"))
    return catalog.filter(F.col("path").startswith(prefix)).join(wanted, "file_date", "left_semi")


def selection_report(selected: DataFrame, dates: DataFrame) -> DataFrame:
    """One row: files found, dates asked for, dates that have a file, whether all have."""
    found = selected.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_distinct("file_date").alias("n_dates_found"),
    )
    asked = dates.agg(F.count_distinct("valid_date").alias("n_dates")).scalar()
    return found.withColumn("n_dates", asked).withColumn(
        "complete", F.col("n_dates_found") == F.col("n_dates")
    )


def latest_date(catalog: DataFrame, prefix: str) -> DataFrame:
    """Date of the newest file under a prefix; null if there is none."""
    under = catalog.filter(F.col("path").startswith(prefix))
    return under.agg(F.max("file_date").alias("latest"))
