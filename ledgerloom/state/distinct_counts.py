"""Distinct counts of any span of periods from one stored state: exact ones from bitmaps, estimates from sketches.

A dictionary gives each key a number, without gaps. The state has, for each group (a month and a region, say) and each
32,768 numbers, a bitmap of those that occur. Bitmaps are united by or, so the distinct keys of a quarter, a year or all
regions are counted from the months' bitmaps without reading the facts again, and late batches just add bitmaps.

Numbers are dense, so a bitmap of a busy group is well filled; state grows with groups times keys over eight bytes at most. Before
bitmaps are built their distinct numbers meet by group and bitmap, at most 32,768 rows each, so no task holds an
unbounded group and no half-built bitmaps are shuffled.

A sketch (HyperLogLog) is 2 to the power ``precision`` registers per group, whatever the number of keys, and needs no dictionary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ranking import global_row_number
from ledgerloom.state.batches import BatchTable

#: 2**14 registers
PRECISION = 14


def sketch_bound(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """Relative error that an estimate stays under but for one in ten thousand, at four standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


class DistinctCounts:
    """Bitmaps of ``key`` by the columns ``groups`` (name to type), with their dictionary, in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, key: str, key_type: T.DataType, groups: Mapping[str, T.DataType]) -> None:
        self.key, self.groups = key, list(groups)
        numbered = T.StructType([T.StructField(key, key_type), T.StructField("number", T.LongType())])
        fields = [T.StructField(name, kind) for name, kind in groups.items()]
        fields += [T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())]
        self.dictionary = BatchTable(spark, f"{folder}/dictionary", numbered)
        self.state = BatchTable(spark, f"{folder}/state", T.StructType(fields))

    def _numbered(self, keys: DataFrame):
        def rows(stored: DataFrame) -> DataFrame:
            new = keys.join(stored, self.key, "left_anti")
            ranked = global_row_number(new, [F.col(self.key).asc()], "number")
            return ranked.withColumn("number", F.col("number") + stored.count())

        return rows

    def add(self, batch: str, activity: DataFrame) -> bool:
        """Folds a batch of (key, groups) in; False if it was there already. NULL keys don't count."""
        seen = activity.select(*self.groups, self.key).filter(F.col(self.key).isNotNull()).distinct()
        self.dictionary.fold(batch, self._numbered(seen.select(self.key).distinct()))
        if any(b.batch == batch for b in self.state.batches()):
            return False
        number = F.col("number")
        placed = seen.join(self.dictionary.read(), self.key).select(
            *self.groups, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")
        )
        together = placed.repartition(*self.groups, "bucket")
        return self.state.append(batch, together.groupBy(*self.groups, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))

    def count(self, *by: Column, name: str = "distinct_keys") -> DataFrame:
        """Distinct keys by expressions over the groups; without any, of all."""
        parts = self.state.read().select(*by, "bucket", "bits")
        columns = parts.columns[: len(by)]
        united = parts.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return united.groupBy(*columns).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def sketches(activity: DataFrame, key: str, groups: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """One mergeable ``sketch`` of the distinct keys per group."""
    return activity.groupBy(*groups).agg(F.hll_sketch_agg(key, precision).alias("sketch"))


def estimates(stored: DataFrame, *by: Column, name: str = "distinct_keys") -> DataFrame:
    """Estimated distinct keys by expressions over the groups of stored sketches."""
    return stored.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
