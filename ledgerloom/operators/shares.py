"""Totals, shares and label counts over small key domains (regions, products, segments)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import percent


def share_of_total(totals: DataFrame, value: str, name: str, places: int = 1) -> DataFrame:
    """Adds each row's percentage of the column total.

    ``totals`` must be grouped by a small domain: the total is a window over its rows.
    """
    everything = Window.partitionBy(F.lit(1))
    return totals.withColumn(
        name, percent(F.col(value), F.sum(value).over(everything), places)
    )


def value_counts(
    df: DataFrame, label: str, name: str = "customers", labels: Sequence[str] | None = None
) -> DataFrame:
    """Rows per label, most frequent first. ``labels`` adds the listed ones that have no row."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias(name))
    if labels is not None:
        spark = df.sparkSession
        known = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in labels])).alias(label))
        counts = known.join(counts, label, "left").fillna({name: 0})
    return counts.orderBy(F.col(name).desc(), F.col(label).asc())


def lookup_with_default(
    df: DataFrame, dim: DataFrame, on: str, column: str, default: object
) -> DataFrame:
    """Adds ``dim[column]`` by key, ``default`` where the key has no row or no value.

    A key that ``dim`` repeats gives its smallest value; rows are never multiplied.
    """
    found = dim.groupBy(on).agg(F.min(column).alias(column))
    return df.join(found, on, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(default))
    )


def sum_where(condition: Column, value: Column) -> Column:
    """Conditional sum, zero when no row qualifies."""
    return F.sum(F.when(condition, value).otherwise(0))
