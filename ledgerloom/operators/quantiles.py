"""Exact quantiles and quantile buckets over any number of distinct values.

``percentile`` keeps every distinct value of a group in one task. Here equal values are counted
first (with map-side combining, so a hot value costs one row per task), the distinct values are put
in global order, and only the ordered blocks that hold a wanted position are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import floor_div
from ledgerloom.operators.ranking import range_ordered


def _targets(total: Column, probabilities: Sequence[Fraction]) -> Column:
    """0-based positions around every quantile: an array of (quantile number, side, position)."""
    wanted = []
    for number, p in enumerate(probabilities):
        scaled = (total - 1) * p.numerator
        low = floor_div(scaled, F.lit(p.denominator))
        high = floor_div(scaled + (p.denominator - 1), F.lit(p.denominator))
        for side, position in ((0, low), (1, high)):
            wanted.append(
                F.struct(
                    F.lit(number).alias("number"),
                    F.lit(side).alias("side"),
                    position.alias("position"),
                )
            )
    return F.array(*wanted)


def ordered_value_counts(
    df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None
) -> DataFrame:
    """Each (group, value) once, in global order and written once.

    Columns: ``_key`` (a struct, so that NULL group keys still compare equal), ``_value`` (NULL last),
    ``_rows``, ``_sum`` of the values and ``_block``, the ordered partition.
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(1).alias("all"))
    counts = (
        df.select(key.alias("_key"), F.col(value).alias("_value"))
        .groupBy("_key", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_value").alias("_sum"))
    )
    order = [F.col("_key").asc(), F.col("_value").asc_nulls_last()]
    return range_ordered(counts, order, partitions).drop("_place")


def ordered_quantiles(ordered: DataFrame, probabilities: Sequence[Fraction]) -> DataFrame:
    """``_key``, ``_total`` (non-NULL rows) and ``_quantiles``, an array in the order asked for.

    Positions between two values are interpolated linearly. Integers and decimals stay exact up to
    the last division.
    """
    kind = dict(ordered.dtypes)["_value"]
    present = ordered.filter(F.col("_value").isNotNull()).withColumnRenamed("_rows", "_n")
    # One row per ordered block and key group, at most blocks + groups rows.
    in_group = Window.partitionBy("_key")
    earlier = in_group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        present.groupBy("_block", "_key")
        .agg(F.sum("_n").alias("_size"))
        .select(
            "_block",
            "_key",
            "_size",
            F.sum("_size").over(in_group).alias("_total"),
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        )
    )
    start, size = F.col("_start"), F.col("_size")
    hits = blocks.select(
        "_block",
        "_key",
        "_start",
        "_total",
        F.filter(
            _targets(F.col("_total"), probabilities),
            lambda t: (t["position"] >= start) & (t["position"] < start + size),
        ).alias("_targets"),
    ).filter(F.size("_targets") > 0)

    # Blocks without a wanted position drop out here; a block is one task's worth of distinct values.
    inside = Window.partitionBy("_block", "_key").orderBy("_value")
    running = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    end = F.col("_end")
    found = (
        present.join(hits, ["_block", "_key"])
        .withColumn("_end", F.col("_start") + running)
        .select(
            "_key",
            "_value",
            "_total",
            F.explode(
                F.filter(
                    "_targets",
                    lambda t: (t["position"] >= end - F.col("_n")) & (t["position"] < end),
                )
            ).alias("_hit"),
        )
    )
    sides = []
    for number in range(len(probabilities)):
        for side in (0, 1):
            here = (F.col("_hit.number") == number) & (F.col("_hit.side") == side)
            sides.append(F.max(F.when(here, F.col("_value"))).alias(f"_q{number}_{side}"))
    values = [
        _between(F.col(f"_q{i}_0"), F.col(f"_q{i}_1"), F.col("_total"), p, kind)
        for i, p in enumerate(probabilities)
    ]
    return (
        found.groupBy("_key")
        .agg(F.max("_total").alias("_total"), *sides)
        .select("_key", "_total", F.array(*values).alias("_quantiles"))
    )


def _between(low: Column, high: Column, total: Column, p: Fraction, kind: str) -> Column:
    """``low + (high - low) * fraction`` where the fraction is ``(n-1)*p`` after the integer part."""
    remainder = ((total - 1) * p.numerator) % p.denominator
    if kind.startswith("decimal"):
        remainder = remainder.cast("decimal(6,0)")
        return low + (high - low) * remainder / F.lit(p.denominator).cast("decimal(6,0)")
    return low + (high - low) * (remainder / p.denominator)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[Fraction | str | float],
    keys: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per key group: ``n`` and ``quantiles`` of the non-NULL values."""
    exact = [Fraction(str(p)) if isinstance(p, float) else Fraction(p) for p in probabilities]
    found = ordered_quantiles(ordered_value_counts(df, keys, value, partitions), exact)
    return found.select(
        *[F.col("_key")[k].alias(k) for k in keys],
        F.col("_total").alias("n"),
        F.col("_quantiles").alias("quantiles"),
    )


def quantile_bucket(
    df: DataFrame,
    column: str,
    buckets: int,
    labels: Sequence[int] | None = None,
    name: str = "bucket",
    duplicates: str = "raise",
    partitions: int | None = None,
) -> DataFrame:
    """Bucket each value between the quantiles 0, 1/k, ..., 1: closed on the right, lowest included.

    ``labels`` run from the lowest bucket to the highest (default 1..k). Two equal edges raise at run
    time; ``duplicates="drop"`` merges the empty bins instead, and then needs the default labels. A
    NULL value gets a NULL bucket.
    """
    if duplicates not in ("raise", "drop"):
        raise ValueError("duplicates must be 'raise' or 'drop'")
    if labels is not None and len(labels) != buckets:
        raise ValueError("quantile_bucket needs one label per bucket")
    if labels is not None and duplicates == "drop":
        raise ValueError("merged bins have no fixed labels")
    cuts = [Fraction(j, buckets) for j in range(buckets + 1)]
    edges = exact_quantiles(df, column, cuts, partitions=partitions)
    # One row whatever the size of the data; Spark inlines it as a constant.
    edge_row = edges.select(F.col("quantiles").cast("array<double>")).scalar()
    value = F.col(column).cast("double")
    with_edges = df.withColumn("_edges", edge_row)
    inner = F.slice("_edges", 2, buckets - 1)
    distinct = F.array_distinct("_edges")
    if duplicates == "raise":
        below = F.size(F.filter(inner, lambda edge: edge < value))
        number = F.when(
            F.size(distinct) <= buckets,
            F.raise_error(F.lit("Bin edges must be unique")).cast("int"),
        ).otherwise(below + 1)
    else:
        merged = F.slice(distinct, 2, F.greatest(F.size(distinct) - 2, F.lit(0)))
        number = F.size(F.filter(merged, lambda edge: edge < value)) + 1
    bucket = F.when(value.isNotNull(), number)
    if labels is not None:
        bucket = F.element_at(F.array(*[F.lit(label) for label in labels]), bucket)
    return with_edges.withColumn(name, bucket.cast("bigint")).drop("_edges")
