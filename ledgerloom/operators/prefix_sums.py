"""Running sums over a whole table, at the grain of its rows.

A window without partition keys, or with a group that holds a third of the rows, sums in one task. Here rows are range
partitioned on the group and the order, so a group spreads over many tasks. Each task sums its rows; the sums of a group's earlier
partitions, one row for each partition and group that meet, are added to its running sums. Sums of decimals and whole
numbers are exact, so the number of partitions cannot change a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ranking import range_ordered


def running_sum(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    name: str = "running",
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows up to each one in ``order``, per group of ``by``. Rows that tie are
    taken in any order, so ``order`` should end in a unique column or in the value.

    NULL values add nothing; NULL groups are a group; NULLs in ``order`` come first.
    """
    columns: list[Column] = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    ordered = range_ordered(df, columns, partitions)
    groups = [F.col(c) for c in by]
    own = ordered.groupBy("_block", *groups).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = own.select(
        F.col("_block").alias("_of"), *[g.alias(f"_{c}") for g, c in zip(groups, by)], F.sum("_sum").over(earlier).alias("_before")
    )
    same = F.col("_block") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy("_block", *by).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ordered.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0))).join(before, same)
    total = F.col("_within") + F.coalesce("_before", F.lit(0))
    return summed.withColumn(name, total).select(*df.columns, name)


def open_by_day(lives: DataFrame, start: str, end: str, by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """How many lives are open at the end of each day on which one starts or ends, per group.

    A life counts from its start to its end, the last day included; one without start never, one that ends before it starts
    neither. Events are counted by day first, so lives are never expanded to days.
    """
    valid = F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))
    events = F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("change")),
        F.struct(F.date_add(F.col(end), 1).alias("day"), F.lit(-1).alias("change")),
    )
    changes = lives.filter(valid).select(*by, F.inline(events)).filter(F.col("day").isNotNull())
    daily = changes.groupBy(*by, "day").agg(F.sum("change").alias("change"))
    return running_sum(daily, "change", ["day"], "open", by, partitions).drop("change")
