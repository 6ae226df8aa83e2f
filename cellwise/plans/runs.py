"""Which dates a run computes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellwise.functions.dates import dates_between, first_month_start
from cellwise.schema import DatasetSpec

# Dates per chunk.
CHUNK = 100


def expected_dates(bounds: DataFrame, start: Column, end: Column, frequency: str) -> DataFrame:
    """All dates that should exist between two dates of a one-row table."""
    return bounds.select(F.explode(dates_between(start, end, frequency)).alias("valid_date"))


def calendar(spark: SparkSession, start: date, end: date, frequency: str) -> DataFrame:
    return expected_dates(spark.range(1), F.lit(start), F.lit(end), frequency)


def planned_dates(bounds: DataFrame, start: Column, end: Column, frequency: str) -> DataFrame:
    """Dates of an archival run: as expected, but a month only counts if its first day does."""
    first = first_month_start(start) if frequency == "M" else start
    return expected_dates(bounds.filter(first <= end), first, end, frequency)


def missing_dates(expected: DataFrame, stats: DataFrame, column: str = "valid_date") -> DataFrame:
    """Expected dates that the statistics table does not have yet."""
    present = stats.select(F.col(column).alias("valid_date")).distinct()
    return expected.join(present, "valid_date", "left_anti")


def missing_intervals(
    stats: DataFrame,
    levels: DataFrame,
    start: date,
    end: date,
    frequency: str,
    column: str = "valid_date",
) -> DataFrame:
    """Runs of dates from ``start`` to ``end`` that each country and level of ``levels`` lacks.

    ``iso3``, ``adm_level``, ``first_date``, ``last_date`` and ``n_dates`` (long). A date counts as
    present only where that country has it at that level. Stored dates off the calendar, and rows
    with a null key, don't count; repeated rows count once. ``frequency`` is as in ``calendar``.

    Gaps lie between neighbours of the stored dates, so the work follows what is stored, not the
    product of calendar and countries: a gap is one row, however long.
    """
    keys = ["iso3", "adm_level"]
    spark = stats.sparkSession
    days = calendar(spark, start, end, frequency).distinct()
    # A calendar: one row per date of a dataset's history, some ten thousand at most.
    place = F.row_number().over(Window.orderBy("valid_date")).alias("nth")
    days = F.broadcast(days.select(F.col("valid_date").alias("day"), place))
    have = stats.select(*keys, F.col(column).alias("day")).distinct().join(days, "day").select(*keys, "nth")
    known = levels.select(*keys).filter("iso3 IS NOT NULL AND adm_level IS NOT NULL").distinct()
    have = have.join(known, keys, "left_semi")
    # A place before the first date and one after the last close the gaps at both ends.
    last = days.agg(F.coalesce(F.max("nth"), F.lit(0))).scalar()
    ends = known.select(*keys, F.explode(F.array(F.lit(0), last + 1)).alias("nth"))
    before = F.lag("nth").over(Window.partitionBy(*keys).orderBy("nth"))
    gaps = have.unionByName(ends).withColumn("before", before).filter("nth - before > 1")
    firsts, lasts = (days.select(F.col("day").alias(f"{n}_date"), F.col("nth").alias(f"{n}_nth")) for n in ("first", "last"))
    return (
        gaps.withColumns({"first_nth": F.col("before") + 1, "last_nth": F.col("nth") - 1})
        .join(firsts, "first_nth")
        .join(lasts, "last_nth")
        .select(*keys, "first_date", "last_date", (F.col("nth") - F.col("before") - 1).cast("long").alias("n_dates"))
    )


def dates_of_intervals(intervals: DataFrame, frequency: str) -> DataFrame:
    """The dates of ``missing_intervals``, each with the countries and levels to fill: what a backfill reads."""
    dates = dates_between(F.col("first_date"), F.col("last_date"), frequency)
    return intervals.select("iso3", "adm_level", F.explode(dates).alias("valid_date"))


def run_dates(*parts: DataFrame) -> DataFrame:
    """Planned and missing dates together, each once."""
    together = parts[0].select("valid_date")
    for part in parts[1:]:
        together = together.union(part.select("valid_date"))
    return together.distinct()


def date_chunks(dates: DataFrame, size: int = CHUNK) -> DataFrame:
    """Number the dates' chunks, ``size`` dates each, in order.

    The window has no partition, but its input is a calendar: one row per day of a dataset's
    history, some ten thousand at most.
    """
    place = F.row_number().over(Window.orderBy("valid_date")) - 1
    return dates.withColumn("chunk_id", F.floor(place / size).cast("int"))


def run_plan(
    spark: SparkSession,
    spec: DatasetSpec,
    as_of: date,
    stats: DataFrame | None = None,
    latest: DataFrame | None = None,
    backfill: bool = False,
) -> DataFrame:
    """Dates of a run with their chunks: the archive, or the latest file's date (``latest``),
    and with ``backfill`` also what the statistics table lacks."""
    end = spec.end or as_of - timedelta(days=1)
    bounds = spark.range(1)
    start, stop = F.lit(spec.start), F.lit(end)
    if latest is not None:
        dates = latest.select(F.col("latest").alias("valid_date")).filter("valid_date IS NOT NULL")
    else:
        dates = planned_dates(bounds, start, stop, spec.frequency)
    if backfill:
        if stats is None:
            raise ValueError("a backfill needs the statistics table")
        dates = run_dates(dates, missing_of(spark, spec, as_of, stats))
    return date_chunks(dates.distinct())


def missing_of(spark: SparkSession, spec: DatasetSpec, as_of: date, stats: DataFrame) -> DataFrame:
    """Dates of a dataset's history, up to yesterday, that its statistics table lacks."""
    end = spec.end or as_of - timedelta(days=1)
    expected = calendar(spark, spec.start, end, spec.frequency)
    return missing_dates(expected, stats, spec.date_column)


def run_summary(
    plan: DataFrame, dataset: str, mode: str, missing: DataFrame | None = None, iso3s: str = ""
) -> DataFrame:
    """One row on a plan: chunks, dates, first and last date, missing dates."""
    totals = plan.agg(
        F.count_distinct("chunk_id").alias("n_chunks"),
        F.count(F.lit(1)).alias("n_dates"),
        F.min("valid_date").alias("first_date"),
        F.max("valid_date").alias("last_date"),
    )
    n_missing = F.lit(0) if missing is None else missing.agg(F.count(F.lit(1))).scalar()
    return totals.select(
        F.lit(dataset).alias("dataset"),
        F.lit(mode).alias("mode"),
        "*",
        n_missing.cast("long").alias("n_missing"),
        F.lit(iso3s).alias("iso3_filter"),
    )
