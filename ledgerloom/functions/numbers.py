"""Decimal-safe arithmetic.

Money stays ``DecimalType`` until the last projection of a report: decimal sums are exact, so a
result does not depend on the order in which partial sums arrive or on a task being run again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT_TYPE = "decimal(16,0)"


def ratio(numerator: Column, denominator: Column, places: int | None = None) -> Column:
    """``numerator / denominator``, NULL on a zero denominator, rounded half away from zero."""
    quotient = numerator / F.nullif(denominator, F.lit(0))
    return quotient if places is None else F.round(quotient, places)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero or NULL."""
    return ratio(F.lit(100) * part, whole, places)


def floor_div(dividend: Column, divisor: Column) -> Column:
    """Integer division in 64 bits, NULL on a zero divisor (``/`` would go through ``double``)."""
    return F.call_function("div", dividend.cast("bigint"), F.nullif(divisor.cast("bigint"), F.lit(0)))


def count_as_decimal(count: Column) -> Column:
    """A count that divides exactly (``bigint / bigint`` would go through ``double``)."""
    return count.cast(COUNT_TYPE)


def mean_of(value: Column, places: int) -> Column:
    """Rounded mean aggregate from an exact sum and a count (``avg`` cuts decimals at 4 more places)."""
    return ratio(F.sum(value), count_as_decimal(F.count(value)), places)


def as_number(value: Column) -> Column:
    """Output edge: a rounded decimal becomes ``double``."""
    return value.cast("double")


def half_even(value: Column, places: int) -> Column:
    """Rounding with ties to the even digit, for callers that need it; reports round ties away."""
    return F.bround(value, places)
