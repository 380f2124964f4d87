"""Counts, sums and sums of squares per period and group, stored and united: statistics of any span without the facts.

The state holds one row per batch, period and group with exact decimals, so uniting them in any order or split gives the same
statistics as one pass over the rows. A span of periods reads only its rows of the state.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.numbers import ratio
from ledgerloom.state.batches import BatchTable

#: values have up to 12 digits, 2 of them after the point
VALUE = T.DecimalType(12, 2)
SUM = T.DecimalType(30, 2)
SQUARES = T.DecimalType(38, 4)


class PartialSums:
    """The state of ``value`` by ``groups`` (name to type) in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, value: str, groups: Mapping[str, T.DataType]) -> None:
        self.value, self.groups = value, list(groups)
        fields = [T.StructField(name, kind) for name, kind in groups.items()]
        fields += [T.StructField("n", T.LongType()), T.StructField("s", SUM), T.StructField("q", SQUARES)]
        self.table = BatchTable(spark, folder, T.StructType(fields))

    def add(self, batch: str, rows: DataFrame) -> bool:
        """Folds a batch of rows in; False if it was there already. NULL values don't count."""
        v = F.col(self.value).cast(VALUE)
        sums = rows.groupBy(*self.groups).agg(
            F.count(v).alias("n"), F.coalesce(F.sum(v), F.lit(0)).cast(SUM).alias("s"), F.coalesce(F.sum(v * v), F.lit(0)).cast(SQUARES).alias("q")
        )
        return self.table.append(batch, sums)

    def compact(self) -> None:
        """Leaves one row per group."""
        self.table.replace(lambda stored: self._united(stored, *self.groups))

    def _united(self, stored: DataFrame, *by) -> DataFrame:
        return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("s").cast(SUM).alias("s"), F.sum("q").cast(SQUARES).alias("q"))

    def statistics(self, *by: Column, where: Column | None = None) -> DataFrame:
        """n, total, mean and sample deviation by expressions over the groups, of the groups that ``where`` chooses.

        Squares around the mean are (n q - s s) / n in exact decimals before they become floating point, so a mean far
        above the deviation takes nothing from it.
        """
        stored = self.table.read()
        united = self._united(stored if where is None else stored.filter(where), *by)
        n, s, q = F.col("n"), F.col("s"), F.col("q")
        # around the mean m rounded to cents: q - 2 m s + n m m, less what rounding leaves
        m = F.when(n > 0, ratio(s, n.cast("decimal(19,0)"), 2)).cast("decimal(14,2)")
        off = (s - n.cast("decimal(19,0)") * m).cast("decimal(30,2)")
        around = (q - (m * (s + off).cast("decimal(24,2)")).cast(SQUARES)).cast(SQUARES)
        squares = around.cast("double") - off.cast("double") * off.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))
        deviation = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.nullif(n - 1, F.lit(0)))
        mean = s.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))
        kept = united.columns[: len(by)]
        return united.select(*kept, "n", s.alias("total"), mean.alias("mean"), F.when(n > 1, deviation).alias("deviation"))
