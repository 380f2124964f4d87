"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """``'YYYY-MM'`` of a date; sorts as text in calendar order."""
    return F.date_format(day, "yyyy-MM")


def month_index(day: Column, base_year: int) -> Column:
    """Months since December of the year before ``base_year`` (January of ``base_year`` is 1)."""
    return (F.year(day) - base_year) * 12 + F.month(day)


def is_quarter_four(month: Column) -> Column:
    """True when a ``'YYYY-MM'`` month is October, November or December."""
    return month.endswith("-10") | month.endswith("-11") | month.endswith("-12")


def tenure_months(start: Column, end: Column) -> Column:
    """Whole calendar months from ``start`` to ``end``, truncated toward zero, negative if reversed.

    ``months_between`` is no substitute: it calls 31 January to 28 February one whole month.
    """
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    short_of_a_month = (F.dayofmonth(end) < F.dayofmonth(start)).cast("int")
    past_a_month = (F.dayofmonth(end) > F.dayofmonth(start)).cast("int")
    return F.when(end >= start, months - short_of_a_month).otherwise(months + past_a_month)
