"""Validation of statistics, quarantine of countries, and the error log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.functions.dates import months_apart
from cellwise.functions.values import is_iso3
from cellwise.schema import QA, to_schema


def rules(columns: Sequence[str], as_of: date) -> dict[str, Column]:
    """Name and condition of every rule a table with these columns must obey, in report order."""
    c = F.col
    found = {
        "min_max": c("min") <= c("max"),
        "mean_between": c("mean").between(c("min"), c("max")),
        "median_between": c("median").between(c("min"), c("max")),
        "std_nonneg": c("std") >= 0,
        "count_nonneg": c("count") >= 0,
        "adm_level": c("adm_level").between(0, 4),
        "iso3": is_iso3(c("iso3")),
    }
    if "issued_date" in columns:
        found["issued_le_valid"] = c("valid_date") >= c("issued_date")
        if "leadtime" in columns:
            found["leadtime_range"] = c("leadtime").between(0, 6)
            found["leadtime_months"] = c("leadtime") == months_apart(
                c("valid_date"), c("issued_date")
            )
    else:
        found["not_future"] = c("valid_date") <= F.lit(as_of)
    return found


def validate(stats: DataFrame, as_of: date) -> DataFrame:
    """Add ``violations``, the names of the rules a row breaks. A null operand passes."""
    broken = [
        F.when(~ok, F.lit(name)) for name, ok in rules(stats.columns, as_of).items()
    ]
    # Joined text keeps this in generated code, which array functions with a lambda leave.
    names = F.split(F.concat_ws(",", *broken), ",")
    return stats.withColumn("violations", F.array_remove(names, ""))


def duplicate_keys(stats: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a batch, nulls equal; a database would refuse them."""
    return stats.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def with_duplicate_rule(validated: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``duplicate_key`` to the violations of rows whose key is not unique in the batch.

    Nulls in a key are equal. ``validated`` is used twice: it should be a stored table.
    """
    twice = duplicate_keys(validated, key).select(
        *[F.col(k).alias(f"_{k}") for k in key], F.lit(True).alias("_twice")
    )
    same = None
    for k in key:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    joined = validated.join(twice, same, "left")
    added = F.when(F.col("_twice"), F.array_append("violations", F.lit("duplicate_key")))
    return joined.withColumn("violations", F.coalesce(added, "violations")).select(
        *validated.columns
    )


def broken_rules(validated: DataFrame, *columns: str) -> DataFrame:
    """One row per broken rule, ``(*columns, nth, rule)``.

    The null test stands after the unfolding on purpose: a test of ``violations`` itself would be
    pushed down and evaluate all rules a second time.
    """
    unfolded = validated.select(*columns, F.posexplode_outer("violations").alias("nth", "rule"))
    return unfolded.filter("rule IS NOT NULL")


def failed_units(validated: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Units (country and date chunk) with a bad row: the first level that failed and its rule.

    Reduced by a partial aggregate, so a country with very many rows costs no more than others.
    """
    order = ["adm_level", "valid_date", "pcode"]
    first = F.min_by(F.struct("adm_level", "rule"), F.struct(*order, "nth"))
    return (
        broken_rules(validated, *unit, *order)
        .groupBy(*unit)
        .agg(first.alias("first"))
        .select(*unit, "first.*")
    )


def passed(validated: DataFrame, failed: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Rows of the units without any bad row; one bad row holds back its whole unit."""
    return validated.join(failed.select(*unit), list(unit), "left_anti").drop("violations")


def qa_rows(
    failed: DataFrame, dataset: str, at: Column | None = None, kind: str | None = "Validation error"
) -> DataFrame:
    """Rows of the error log; the level is null if no level was reached.

    ``kind`` goes before the rule in the error's text; ``None`` for troubles that no rule of
    ``validate`` found. A column ``detail`` of ``failed``, if there is one, follows the rule.
    """
    stamp = F.current_timestamp() if at is None else at
    rows = failed.select(
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("date"),
        "iso3",
        "adm_level",
        F.lit(dataset).alias("dataset"),
        F.concat_ws(": ", F.lit(kind), F.col("rule"), *[F.col(c) for c in failed.columns if c == "detail"]).alias("error"),
        F.col("rule").alias("stack_trace"),
    )
    return to_schema(rows, QA)


def violation_summary(validated: DataFrame, *by: str) -> DataFrame:
    """Number of rows per broken rule."""
    return (
        broken_rules(validated, *by)
        .groupBy(*by, "rule")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def outside_grid(countries: DataFrame, spans: DataFrame) -> DataFrame:
    """Countries whose bounds hold no cell of the raster: they fail before any level."""
    missed = countries.join(spans.select("iso3"), "iso3", "left_anti")
    return missed.select(
        "iso3", F.lit(None).cast("int").alias("adm_level"), F.lit("no_cells_in_bounds").alias("rule")
    )


def with_coverage(countries: DataFrame, coverage: DataFrame, dataset: str) -> DataFrame:
    """Countries a dataset covers; a dataset without a list covers all.

    The listed countries are kept by a semi join; whether there is a list is asked of the
    coverage table itself, as a value, not by a second job.
    """
    listed = coverage.filter(F.col("dataset") == dataset).select("iso3")
    marked = countries.join(listed.distinct().withColumn("_listed", F.lit(True)), "iso3", "left")
    n_listed = listed.agg(F.count(F.lit(1))).scalar()
    return marked.filter((n_listed == 0) | F.col("_listed").isNotNull()).drop("_listed")
