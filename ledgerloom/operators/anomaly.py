"""Outliers against a global baseline and value statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.numbers import count_as_decimal, floor_div, ratio

#: decimals of up to so many digits have exact squares and sums of squares
NARROW = 12
#: the place of a value between the least (0) and the largest (1)
PLACE = "decimal(19,18)"


def zscore_outliers(
    df: DataFrame,
    column: str,
    baseline: Column | None = None,
    threshold: float = 3.0,
    name: str = "z_score",
) -> DataFrame:
    """Rows whose ``column`` lies more than ``threshold`` sample deviations above the baseline mean.

    The baseline rows may be fewer than the scored ones. Mean and deviation are a one-row scalar
    subquery, so there is no join. A constant baseline has no outliers.

    Nothing cancels, whatever the mean, size or scale of the values, and sums are decimals, so the order of
    the partial sums can't change the statistics. Infinite values and NaN are not in the baseline.
    """
    base = df if baseline is None else df.filter(baseline)
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        kind = T.DecimalType(20, 0)
    elif not isinstance(kind, T.DecimalType):
        kind = T.DoubleType()
    value = value.cast(kind)
    narrow = isinstance(kind, T.DecimalType) and kind.precision <= NARROW
    statistics = (_of_narrow(base, value, kind) if narrow else _of_places(base, value)).scalar()
    z = (_place(value, "_baseline") - F.col("_baseline.mean")) / F.nullif(F.col("_baseline.deviation"), F.lit(0.0))
    return (
        df.withColumn("_baseline", statistics)
        .withColumn(name, z)
        .filter(F.col(name) > threshold)
        .drop("_baseline")
    )


def _place(value: Column, ends: str) -> Column:
    return (value - F.col(f"{ends}.low")).cast("double") / F.nullif(F.col(f"{ends}.width"), F.lit(0.0))


def _statistics(sums: DataFrame, low: Column, width: Column, squares: Column) -> DataFrame:
    """One row: the line that values are measured on, mean and deviation there."""
    n, s = F.col("n").cast("double"), F.col("s").cast("double")
    deviation = F.sqrt(squares / F.nullif(n - 1, F.lit(0.0)))
    return sums.select(
        F.struct(low.alias("low"), width.alias("width"), (s / F.nullif(n, F.lit(0.0))).alias("mean"), deviation.alias("deviation"))
    )


def _of_narrow(base: DataFrame, value: Column, kind: T.DecimalType) -> DataFrame:
    """One pass: squares around the rounded mean m, as q - m (2 s - n m) in exact decimals, less what rounding adds."""
    sums = base.agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.sum(value * value).alias("q"))
    n, s, q = (F.col(c) for c in ("n", "s", "q"))
    count = F.nullif(n.cast("double"), F.lit(0.0))
    middle = (s.cast("double") / count).cast(kind)
    off = s - n.cast("decimal(19,0)") * middle
    around = q - middle * (s + off).cast(T.DecimalType(kind.precision + 11, kind.scale))
    squares = around.cast("double") - off.cast("double") * off.cast("double") / count
    return _statistics(sums, F.lit(0).cast(kind), F.lit(1.0), squares)


def _of_places(base: DataFrame, value: Column) -> DataFrame:
    """Two passes: the least and largest value, then the places of values between them (0 to 1) and their squares.

    Both ends occur, so the squared deviations of the places sum to half or more.
    """
    finite = F.when(F.abs(value.cast("double")) < float("inf"), value)
    low, high = F.min(finite), F.max(finite)
    ends = base.agg(low.alias("low"), (high - low).cast("double").alias("width")).select(F.struct("low", "width")).scalar()
    x = F.col("x")
    sums = (
        base.withColumn("_ends", ends)
        .select(F.col("_ends"), _place(finite, "_ends").alias("x"))
        .agg(F.first("_ends").alias("ends"), F.count(x).alias("n"), F.sum(x.cast(PLACE)).alias("s"), F.sum((x * x).cast(PLACE)).alias("q"))
    )
    n, s, q = (F.col(c).cast("double") for c in ("n", "s", "q"))
    return _statistics(sums, F.col("ends.low"), F.col("ends.width"), q - s * s / F.nullif(n, F.lit(0.0)))


def value_bin(value: Column) -> Column:
    """A bin that grows with the value: 32 bins for each doubling of 1 + its size, on either side of 0."""
    size = F.log2(1 + F.abs(value.cast("double")))
    return (F.signum(value.cast("double")) * F.floor(32 * size)).cast("int")


def value_profile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    dimension: DataFrame | None = None,
    on: str | None = None,
) -> DataFrame:
    """Rows, mean, exact median and maximum of ``value`` per key group.

    Keys that ``df`` lacks come from ``dimension``, joined by its unique column ``on``. A first pass reduces
    the rows to a histogram (count, sum and maximum per group and bin) before anything is shuffled, so a
    hot group or a hot ``on`` key is a few hundred rows per task. That gives all figures but the median,
    and the bins that hold the middle positions. A second pass looks only at rows in those bins and
    counts their distinct values.
    """
    own = [k for k in keys if k in df.columns]
    by = own if dimension is None else [on, *own]
    rows = df.select(*by, F.col(value).alias("_value"), value_bin(F.col(value)).alias("_bin"))

    def placed(part: DataFrame) -> DataFrame:
        if dimension is not None:
            others = [k for k in keys if k not in own]
            part = part.join(dimension.select(on, *others), on)
        return part.withColumn("_key", F.struct(*keys) if keys else F.struct(F.lit(1).alias("all")))

    bins = (
        placed(
            rows.groupBy(*by, "_bin").agg(
                F.count(F.lit(1)).alias("_rows"), F.sum("_value").alias("_sum"), F.max("_value").alias("_max")
            )
        )
        .groupBy("_key", "_bin")
        .agg(F.sum("_rows").alias("_rows"), F.sum("_sum").alias("_sum"), F.max("_max").alias("_max"))
    )
    present = F.when(F.col("_bin").isNotNull(), F.col("_rows"))
    totals = bins.groupBy("_key").agg(
        F.sum("_rows").alias("rows"),
        ratio(F.sum("_sum"), count_as_decimal(F.sum(present))).alias("mean"),
        F.max("_max").alias("maximum"),
    )
    # one row per group and bin: at most a few hundred for a group
    in_group = Window.partitionBy("_key")
    before = in_group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    start, n = F.col("_start"), F.col("_n")
    low, high = floor_div(n - 1, F.lit(2)), floor_div(n, F.lit(2))
    wanted = (
        bins.filter(F.col("_bin").isNotNull())
        .withColumns({"_n": F.sum("_rows").over(in_group), "_start": F.coalesce(F.sum("_rows").over(before), F.lit(0))})
        .filter((high >= start) & (low < start + F.col("_rows")))
        .select("_key", "_bin", "_start", "_n")
    )
    # two bins of each group at most, so the rows are cut before they are joined with the dimension
    parts = [F.col(f"_key.{k}").alias(k) for k in own]
    here = wanted.select(F.struct(*parts, F.col("_bin").alias("_bin")).alias("_cell")).distinct()
    near = rows.withColumn("_cell", F.struct(*own, "_bin")).join(here, "_cell", "left_semi")
    counts = (
        placed(near.groupBy(*by, "_bin", "_value").agg(F.count(F.lit(1)).alias("_rows")))
        .groupBy("_key", "_bin", "_value")
        .agg(F.sum("_rows").alias("_rows"))
        .join(wanted, ["_key", "_bin"])
    )
    upto = Window.partitionBy("_key", "_bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    end = start + F.sum("_rows").over(upto)
    places = counts.withColumn("_end", end)

    def at(position: Column) -> Column:
        hit = (position >= F.col("_end") - F.col("_rows")) & (position < F.col("_end"))
        return F.max(F.when(hit, F.col("_value")))

    medians = places.groupBy("_key").agg(at(low).alias("_low"), at(high).alias("_high"))
    return totals.join(medians, "_key", "left").select(
        *[F.col("_key")[k].alias(k) for k in keys],
        "rows",
        "mean",
        (F.col("_low") + (F.col("_high") - F.col("_low")) / 2).alias("median"),
        "maximum",
    )
