"""Keep-first over batches: of each key the row that is first in a total order, whatever batch it came in.

The state holds rows that were first when their batch came. A new batch is cut to its first copies, and only those
that come before the stored row of their key, or whose key is new, are added; ties leave the stored row. The current rows are
the first ones of the state. Since taking the first is associative and commutative, the result is that of one pass
over all rows, for every split into batches and every order of them, and also if batches come twice.

A batch shuffles itself and the state's rows once, both cut to one row a key and task before; a key with very many rows costs
one row a task. :meth:`FirstCopies.compact` leaves only current rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.cleaning import dedupe_keep_first
from ledgerloom.state.batches import BatchTable


class FirstCopies:
    """The state in ``folder``. Rows that are equal in ``keys`` and ``order`` should be equal altogether."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> None:
        self.table = BatchTable(spark, folder, schema)
        self.keys, self.order = list(keys), list(order)

    def _first(self, rows: DataFrame) -> DataFrame:
        return dedupe_keep_first(rows, self.keys, self.order)

    def add(self, batch: str, rows: DataFrame) -> bool:
        """Folds a batch in; False if it was there already."""

        def earlier(stored: DataFrame) -> DataFrame:
            tagged = stored.withColumn("_new", F.lit(False)).unionByName(rows.select(*stored.columns).withColumn("_new", F.lit(True)))
            return dedupe_keep_first(tagged, self.keys, [*self.order, "_new"]).filter("_new").drop("_new")

        return self.table.fold(batch, earlier)

    def current(self) -> DataFrame:
        return self._first(self.table.read())

    def compact(self) -> None:
        self.table.replace(self._first)
