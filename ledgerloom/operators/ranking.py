"""Global ranks and rank buckets without a one-task window.

A window without partition keys sorts the whole table in one task. Here the rows are range
partitioned on the full order (so equal leading values still spread over many tasks by the tie-break
column), numbered inside each partition, and shifted by the sizes of the partitions before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import floor_div
from ledgerloom.session import durable

# monotonically_increasing_id() = partition number * 2**33 + row number inside the partition
_ROW_BITS = 33


def range_ordered(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` in global order with ``_block`` (ordered partition number) and ``_place`` (from 0).

    The result is durable: a second range partitioning could draw other boundaries, and all readers
    have to agree on them. Without ``partitions`` adaptive execution picks the number by data size.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    position = F.monotonically_increasing_id()
    numbered = ranged.sortWithinPartitions(*order).withColumn("_position", position)
    return durable(
        numbered.withColumns(
            {
                "_block": F.shiftright("_position", _ROW_BITS),
                "_place": F.col("_position").bitwiseAND((1 << _ROW_BITS) - 1),
            }
        ).drop("_position")
    )


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_number",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds the 1-based position of each row in ``order``, which must end in a unique column.

    ``total`` names an optional column for the number of rows.
    """
    ordered = range_ordered(df, order, partitions)
    # One row per partition of the data: its size is the partition count, not the data.
    sizes = ordered.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "_block",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everything).alias("_total"),
    )
    ranked = ordered.join(F.broadcast(offsets), "_block").withColumn(
        name, F.col("_offset") + F.col("_place") + 1
    )
    if total:
        ranked = ranked.withColumn(total, F.col("_total"))
    return ranked.drop("_block", "_place", "_offset", "_total")


def ntile_of(position: Column, total: Column, buckets: int) -> Column:
    """SQL NTILE from a 1-based position: the first ``total mod buckets`` buckets hold one row more."""
    small = floor_div(total, F.lit(buckets))
    larger_buckets = total % buckets
    in_larger = larger_buckets * (small + 1)
    return F.when(position <= in_larger, floor_div(position + small, small + 1)).otherwise(
        larger_buckets + floor_div(position - in_larger + small - 1, small)
    )
