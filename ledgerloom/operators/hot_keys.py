"""Joins that find the keys with very many rows and split just those.

A join by shuffle puts all rows of a key into one task. The keys that would fill one are found by a heavy-hitter summary:
a sketch of bounded size per task, merged, of the hash of the key. Each of those keys is dealt into slices by a
hash of the row; the other side's rows of the key go to every slice. All other keys are joined as always. Whatever the sketch
says, the result is that of the plain join: it only decides what is split.

The slice of a row depends on its values and its partition, not on its place there, so a task that runs again after an executor is
lost sends the same rows to the same slices. Equal rows spread as far as their partitions do.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: slices that an average task's rows of one key are cut into, so that a few meeting by chance do no harm
FINENESS = 8
#: a key is split from this share of an average task's rows on
HEAVY = 0.25
#: entries of the summary per task of the join; none with the share above is missed
TRACKED = 32
#: which side is split for which join; both sides only where no row may come out unmatched
SPLIT = {"inner": "both", "left": "left", "left_semi": "left", "left_anti": "left", "right": "right"}


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash that is equal where a join takes the keys as equal."""
    parts = []
    for key in keys:
        floating = isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType))
        parts.append(F.col(key) + F.lit(0).cast(df.schema[key].dataType) if floating else F.col(key))  # -0.0 is 0.0
    return F.xxhash64(*parts)


def key_summary(df: DataFrame, keys: Sequence[str], tracked: int) -> DataFrame:
    """One row: ``rows`` and a mergeable ``sketch`` of the most frequent keys' hashes."""
    hashed = df.select(key_hash(df, keys).alias("h"))
    return hashed.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"))


def united(summaries: DataFrame, tracked: int) -> DataFrame:
    """One summary of what several describe, such as those of batches."""
    return summaries.agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the heaviest keys with their rows, of ``rows`` in all."""

    rows: int
    heavy: dict[int, int]

    def slices(self, tasks: int, fineness: int = FINENESS) -> dict[int, int]:
        """Slices of each key that would fill a good part of one of so many tasks."""
        average = self.rows / tasks
        return {h: math.ceil(n * fineness / average) for h, n in self.heavy.items() if n > HEAVY * average}


def hot_keys(summary: DataFrame, tasks: int) -> HotKeys:
    """The keys that may hold more than ``HEAVY`` of an average task: at most ``tasks / HEAVY`` and some that look like it."""
    wanted = math.ceil(2 * tasks / HEAVY)
    row = summary.select("rows", F.expr(f"approx_top_k_estimate(sketch, {wanted})").alias("top")).first()
    return HotKeys(row.rows, {item["item"]: item["count"] for item in row.top or ()})


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _own_slice(df: DataFrame, spread: Sequence[str] | None, count: Column) -> Column:
    columns = spread if spread is not None else [f.name for f in df.schema if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(F.lit("slice"), F.spark_partition_id(), *columns), count)


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    tasks: int | None = None,
    summary: DataFrame | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` with the heavy keys split over tasks.

    The left side is split, for ``right`` joins the right one, for ``inner`` ones each side by its own rows. ``tasks`` (default: the
    session's shuffle partitions) says when a key is heavy; ``summary`` is one of the split side that is there already;
    ``spread`` names columns that tell the rows of a key apart (default: all). NULL keys match nothing and are split like others.
    Both sides are read once more, their keys only, unless a summary is given.
    """
    keys = list(keys)
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"{key} has different types: {left.schema[key].dataType} and {right.schema[key].dataType}")
    if how not in SPLIT:
        raise ValueError(f"{how}: only {', '.join(SPLIT)} joins can be split")
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracked = max(TRACKED * tasks, 64)
    cuts: dict[str, dict[int, int]] = {"left": {}, "right": {}}
    for side, df in (("left", left), ("right", right)):
        if SPLIT[how] in (side, "both"):
            given = summary if summary is not None and SPLIT[how] != "both" else key_summary(df, keys, tracked)
            cuts[side] = hot_keys(given, tasks).slices(tasks)
    if not (cuts["left"] or cuts["right"]):
        return left.join(right, keys, how)
    listed = [
        {"_hot": h, "_of_left": cuts["left"].get(h, 1), "_of_right": cuts["right"].get(h, 1)}
        for h in sorted(cuts["left"].keys() | cuts["right"].keys())
    ]
    # at most a few entries per task of the join: the bound of this broadcast
    entries = F.from_json(F.lit(json.dumps(listed)), "array<struct<_hot: bigint, _of_left: int, _of_right: int>>")
    hot = F.broadcast(spark.range(1).select(F.inline(entries)))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        named = df.withColumn("_hot", key_hash(df, keys)).join(hot, "_hot", "left").drop("_hot")
        mine = _own_slice(df, spread if df is left else None, F.coalesce(f"_of_{own}", F.lit(1))).cast("int")
        return (
            named.withColumn(f"_{own}", mine)
            .withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), F.coalesce(f"_of_{other}", F.lit(1)) - 1)))
            .drop("_of_left", "_of_right")
        )

    joined = dealt(left, "left", "right").join(dealt(right, "right", "left"), [*keys, "_left", "_right"], how)
    return joined.drop("_left", "_right")
