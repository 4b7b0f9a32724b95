"""Column expressions that turn raw text into typed values, and the tests the rules apply.

A failed conversion gives NULL under any ANSI setting, and that NULL is what the rules look for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Without a full date the parser would read '2026' as New Year and '12:30' as a time of today.
FULL_DATE_PREFIX = r"^\s*[+-]?\d{4,6}-\d{1,2}-\d{1,2}"


def to_long(text: Column) -> Column:
    """Whole numbers only: '1.5' is NULL, not 1."""
    return text.try_cast("bigint")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_instant(text: Column) -> Column:
    return F.when(text.rlike(FULL_DATE_PREFIX), F.try_to_timestamp(text))


def is_missing(value: Column) -> Column:
    return value.isNull()


def is_not_positive(value: Column) -> Column:
    """True unless the value is known to be above zero."""
    return ~F.coalesce(value > 0, F.lit(False))


def is_not_price(value: Column) -> Column:
    """True unless the value is a finite number above zero; NaN sorts above infinity in Spark."""
    return ~F.coalesce((value > 0) & (value < float("inf")), F.lit(False))
