"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of a date in a file name.
NAME_DATE = "([0-9]{4}-[0-9]{2}-[0-9]{2})"


def date_in_name(path: Column) -> Column:
    """First date in a file name, null if there is none or it is no calendar date."""
    found = F.nullif(F.regexp_extract(path, NAME_DATE, 1), F.lit(""))
    return F.try_to_date(found, "yyyy-MM-dd")


def issued_date(valid_date: Column, leadtime: Column) -> Column:
    """Issue date of a forecast: the valid date less its leadtime in months."""
    return F.add_months(valid_date, -leadtime.cast("int"))


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two dates, years counted as twelve."""
    return F.floor(F.months_between(later, earlier)).cast("int")


def dates_between(start: Column, end: Column, frequency: str) -> Column:
    """Array of the expected dates: every day, or every first of a month."""
    if frequency == "D":
        return F.sequence(start, end, F.expr("interval 1 day"))
    if frequency == "M":
        return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    raise ValueError(f"frequency must be D or M, not {frequency!r}")


def first_month_start(day: Column) -> Column:
    """The first of a month that is not before ``day``."""
    return F.when(F.dayofmonth(day) == 1, day).otherwise(
        F.add_months(F.trunc(day, "MM"), 1)
    )
