"""Rows at given positions of several orders at once, and the buckets cut by them.

Scoring a table by several measures needs no rank per row: a row's bucket follows from comparing it
with the few rows that end the buckets. All measures are sorted in one range partitioning of narrow
(measure, value, id) rows, and the rows at the wanted positions are looked up by place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import floor_div
from ledgerloom.operators.ranking import range_ordered

# From the number of rows to a 0-based position.
Position = Callable[[Column], Column]

NOT_UNIQUE = "Bin edges must be unique"


def ntile_ends(buckets: int) -> list[Position]:
    """Last position of every NTILE bucket but the last one."""
    return [
        lambda n, j=j: j * floor_div(n, F.lit(buckets)) + F.least(F.lit(j), n % buckets) - 1
        for j in range(1, buckets)
    ]


def quantile_ends(buckets: int) -> list[Position]:
    """Last position of every bucket but the last when ranks are cut at their quantiles."""
    return [lambda n, j=j: floor_div(j * (n - 1), F.lit(buckets)) for j in range(1, buckets)]


def quantile_sides(buckets: int) -> list[Position]:
    """The two positions around every inner quantile: low, high, low, high, ..."""
    sides: list[Position] = []
    for j in range(1, buckets):
        sides.append(lambda n, j=j: floor_div(j * (n - 1), F.lit(buckets)))
        sides.append(lambda n, j=j: floor_div(j * (n - 1) + buckets - 1, F.lit(buckets)))
    return sides


def sort_key(value: Column, tiebreak: Column) -> Column:
    """Compares by value, NULL last, then by the tie-break."""
    return F.struct(
        value.isNull().alias("missing"), value.alias("value"), tiebreak.alias("tiebreak")
    )


def order_statistics(
    df: DataFrame,
    measures: Mapping[str, Column],
    tiebreak: str,
    wanted: Mapping[str, Sequence[Position]],
    partitions: int | None = None,
) -> DataFrame:
    """One row: ``<measure>_<i>``, the :func:`sort_key` at ``wanted[measure][i]``, and ``total``.

    ``tiebreak`` must be unique. All measures take the widest of their types.
    """
    names = list(measures)
    long = df.select(
        F.col(tiebreak).alias("_tie"),
        F.posexplode(F.array(*measures.values())).alias("_measure", "_value"),
    )
    order = [F.col(c).asc() for c in ("_measure", "_missing", "_value", "_tie")]
    ordered = range_ordered(
        long.withColumn("_missing", F.col("_value").isNull()), order, partitions
    )

    # A measure fills a run of places in each block: one row per block and measure.
    in_measure = Window.partitionBy("_measure")
    earlier = in_measure.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        ordered.groupBy("_block", "_measure")
        .agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
        .withColumns(
            {
                "_total": F.sum("_size").over(in_measure),
                "_start": F.coalesce(F.sum("_size").over(earlier), F.lit(0)),
            }
        )
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(number).alias("measure"),
                F.lit(i).alias("index"),
                position(F.col("_total")).alias("position"),
            )
            for number, name in enumerate(names)
            for i, position in enumerate(wanted.get(name, ()))
        ]
    )
    start, size = F.col("_start"), F.col("_size")
    hits = runs.select(
        "_block",
        "_first",
        "_start",
        "_total",
        F.explode(
            F.filter(
                targets,
                lambda t: (t["measure"] == F.col("_measure"))
                & (t["position"] >= start)
                & (t["position"] < start + size),
            )
        ).alias("_hit"),
    ).select(
        "_block",
        (F.col("_first") + F.col("_hit.position") - start).alias("_place"),
        "_total",
        "_hit",
    )
    # As many rows as wanted positions, whatever the size of the data.
    found = ordered.join(F.broadcast(hits), ["_block", "_place"])
    key = sort_key(F.col("_value"), F.col("_tie"))
    columns = [
        F.max(
            F.when((F.col("_hit.measure") == number) & (F.col("_hit.index") == i), key)
        ).alias(f"{name}_{i}")
        for number, name in enumerate(names)
        for i in range(len(wanted.get(name, ())))
    ]
    return found.agg(F.max("_total").alias("total"), *columns)


def bucket_after(own: Column, ends: Sequence[Column]) -> Column:
    """1 plus the number of bucket ends that lie before the row."""
    passed = F.lit(1).cast("bigint")
    for end in ends:
        passed = passed + (end < own).cast("bigint")
    return passed


def rank_buckets(
    df: DataFrame,
    measures: Mapping[str, Column],
    tiebreak: str,
    ends: Sequence[Position],
    partitions: int | None = None,
) -> DataFrame:
    """Adds one bucket column per measure, 1 for the lowest values; one global sort for all of them.

    ``df`` is read twice: hand in a stored or durable frame.
    """
    cuts = order_statistics(df, measures, tiebreak, {name: ends for name in measures}, partitions)
    with_cuts = df.withColumn("_cuts", cuts.select(F.struct(*cuts.columns)).scalar())
    return with_cuts.withColumns(
        {name: _bucket(cuts, name, column, tiebreak, len(ends)) for name, column in measures.items()}
    ).drop("_cuts")


def global_ntile(
    df: DataFrame, buckets: int, values: Mapping[str, Column], tiebreak: str, partitions: int | None = None
) -> DataFrame:
    """Adds ``NTILE(buckets) OVER (ORDER BY value NULLS LAST, tiebreak)`` for each new column of ``values``.

    Only (value, tiebreak) is sorted, once for all columns; ``df`` is read twice.
    """
    return rank_buckets(df, values, tiebreak, ntile_ends(buckets), partitions)


def rank_quantile_buckets(
    df: DataFrame, buckets: int, values: Mapping[str, Column], tiebreak: str, partitions: int | None = None
) -> DataFrame:
    """Quantile bucket (1 = lowest) of the rank of each value, ties ranked by ``tiebreak``.

    Ranks 1..n have the quantile edges ``1 + (n-1)*j/buckets``, closed on the right. That differs from NTILE
    when n is no multiple. A single row has no distinct edges and raises. Only (value, tiebreak) is
    sorted, once for all columns; ``df`` is read twice.
    """
    cuts = order_statistics(
        df, values, tiebreak, {name: quantile_ends(buckets) for name in values}, partitions
    )
    with_cuts = df.withColumn("_cuts", cuts.select(F.struct(*cuts.columns)).scalar())
    single = F.raise_error(F.lit(NOT_UNIQUE)).cast("bigint")
    return with_cuts.withColumns(
        {
            name: F.when(F.col("_cuts.total") == 1, single).otherwise(
                _bucket(cuts, name, column, tiebreak, buckets - 1)
            )
            for name, column in values.items()
        }
    ).drop("_cuts")


def _bucket(cuts: DataFrame, name: str, column: Column, tiebreak: str, ends: int) -> Column:
    kind = cuts.schema[f"{name}_0"].dataType["value"].dataType
    own = sort_key(column.cast(kind), F.col(tiebreak))
    return bucket_after(own, [F.col(f"_cuts.{name}_{i}") for i in range(ends)])


def recency_and_rank_buckets(
    df: DataFrame,
    by_value: tuple[str, str],
    by_rank: Mapping[str, str],
    tiebreak: str,
    buckets: int,
    partitions: int | None = None,
    duplicates: str = "raise",
) -> DataFrame:
    """Quantile buckets of one column by value and of others by rank, from one global sort.

    ``by_value`` and ``by_rank`` map new bucket columns to their source columns. Results equal
    ``quantile_bucket`` and ``rank_quantile_buckets``. Equal edges of the values raise; with
    ``duplicates="drop"`` their empty bins merge, and ``<name>_bins`` tells how many are left. No source
    value may be NULL. ``df`` is read twice: hand in a stored or durable frame.
    """
    if duplicates not in ("raise", "drop"):
        raise ValueError("duplicates must be 'raise' or 'drop'")
    name, column = by_value
    measures = {name: F.col(column), **{new: F.col(old) for new, old in by_rank.items()}}
    # The first and the last place are edges too: equal ones have to be noticed.
    outer = [lambda n: n * 0, lambda n: n - 1]
    wanted = {name: quantile_sides(buckets) + outer}
    wanted.update({new: quantile_ends(buckets) for new in by_rank})
    cuts = order_statistics(df, measures, tiebreak, wanted, partitions)
    with_cuts = df.withColumn("_cuts", cuts.select(F.struct(*cuts.columns)).scalar())

    total = F.col("_cuts.total")

    def place(i: int) -> Column:
        return F.col(f"_cuts.{name}_{i}")["value"].cast("double")

    edges = []
    for j in range(1, buckets):
        low, high = place(2 * j - 2), place(2 * j - 1)
        edges.append(low + (high - low) * ((j * (total - 1)) % buckets / buckets))
    value = F.col(column).cast("double")
    all_edges = [place(2 * buckets - 2), *edges, place(2 * buckets - 1)]
    equal = F.lit(False)
    for left, right in zip(all_edges, all_edges[1:]):
        equal = equal | (left == right)
    # an edge counts unless it equals the one before it or the last one, whose bin is empty then
    inner, bins = F.lit(1).cast("bigint"), F.lit(1).cast("bigint")
    for left, edge in zip(all_edges, edges):
        counts = (edge > left) & (edge < all_edges[-1])
        inner = inner + ((edge < value) & counts).cast("bigint")
        bins = bins + counts.cast("bigint")
    raised = F.raise_error(F.lit(NOT_UNIQUE)).cast("bigint")
    if duplicates == "raise":
        columns = {name: F.when(equal, raised).otherwise(inner)}
    else:
        columns = {name: inner, f"{name}_bins": bins}
    for new in by_rank:
        columns[new] = _bucket(cuts, new, measures[new], tiebreak, buckets - 1)
    return with_cuts.withColumns(columns).drop("_cuts")
