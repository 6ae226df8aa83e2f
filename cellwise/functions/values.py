"""Numeric and text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of a country code.
ISO3 = "^[A-Z]{3}$"


def number(value: Column) -> Column:
    """``value`` with NaN as null, so that every aggregate ignores missing cells."""
    return F.nanvl(value, F.lit(None).cast("double"))


def percent_difference(a: Column, b: Column) -> Column:
    """Symmetric difference of two values in percent, rounded to four places."""
    return F.round(F.abs(F.try_divide(a - b, (a + b) / 2) * 100), 4)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def is_iso3(code: Column) -> Column:
    return code.rlike(ISO3)


def codes_in(text: Column, mark: str = "|") -> Column:
    """The distinct, trimmed, non-empty codes of a list such as ``AFG | NGA``."""
    parts = F.transform(F.split(text, f"[{mark}]"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def contains_text(column: Column, phrase: str) -> Column:
    """Case-insensitive containment; false for null."""
    return F.coalesce(F.lower(column).contains(phrase.lower()), F.lit(False))


def language_of(name_column: str) -> str:
    """Language code of a name column such as ``ADM1_FR``."""
    return name_column[-2:]


def sum_present(*columns: Column) -> Column:
    """Row-wise sum with null as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])
