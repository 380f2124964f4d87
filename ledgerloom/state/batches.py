"""Tables that grow by batches: each batch is there whole or not at all, and once.

A table is a folder with ``data/load=<name>`` (one folder of parquet files per batch, which may be partitioned) and ``ledger/<number>.json`` (one entry per
published batch). Readers read just the data that entries name. A batch is written under a new name and published by the
rename of its entry, which fails if the number is taken, so

* a load that breaks leaves files that no entry names: nothing is seen of it, and it is loaded again from the start;
* a load that runs again finds its batch id in the ledger and does nothing;
* of two loads at once the slower one finds its number taken, looks at what the other has written and starts again.

With key columns only rows with new keys are added: they are anti-joined with the stored keys, and of several new rows with a key
the first in a stated order stays. Entries may replace all data before them (:meth:`BatchTable.replace`), to merge files or
state; the batches remain known.

The rename must not overwrite, as on HDFS or one machine's disk; object stores need a committer of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = "number long, batch string, path string, rows long, replaces boolean"


@dataclass(frozen=True)
class Batch:
    number: int
    batch: str
    path: str
    rows: int
    replaces: bool


def new_path() -> str:
    return f"data/load=b{uuid.uuid4().hex}"


def _plain(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


class BatchTable:
    """A table in ``folder``. ``write(df, path)`` lays out a batch's files (default: as they come)."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        write: Callable[[DataFrame, str], None] = _plain,
    ) -> None:
        self.spark, self.folder, self.schema, self._write = spark, folder.rstrip("/"), schema, write

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{path}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def batches(self) -> list[Batch]:
        """Published batches in order: one row each, written by :meth:`append`."""
        fs, ledger = self._fs("ledger")
        if not fs.exists(ledger):
            return []
        rows = self.spark.read.schema(_ENTRY).json(f"{self.folder}/ledger/*.json").collect()
        return sorted((Batch(**row.asDict()) for row in rows), key=lambda b: b.number)

    def _live(self, known: Sequence[Batch]) -> list[Batch]:
        first = max((k for k, b in enumerate(known) if b.replaces), default=0)
        return [b for b in known[first:] if b.rows]

    def read(self, known: Sequence[Batch] | None = None) -> DataFrame:
        """The rows of all published batches, or of those that ``known`` lists (what a reader saw before)."""
        live = self._live(self.batches() if known is None else known)
        if not live:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.folder}/{b.path}" for b in live]
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/data").parquet(*paths)
        return rows.select(*self.schema.names)

    def append(self, batch: str, df: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = ()) -> bool:
        """Adds a batch unless it is there; False if it was. With ``keys``, only rows with keys that are new."""
        return self.fold(batch, lambda stored: new_rows(df, stored, keys, order) if keys else df)

    def fold(self, batch: str, rows: Callable[[DataFrame], DataFrame]) -> bool:
        """Adds ``rows(what is stored)`` as a batch unless it is there; False if it was.

        The function may be called again, with what another writer has added meanwhile.
        """
        while True:
            known = self.batches()
            if any(b.batch == batch for b in known):
                return False
            if self._publish(known, batch, rows(self.read(known)), replaces=False):
                return True

    def replace(self, rows: Callable[[DataFrame], DataFrame]) -> None:
        """Puts ``rows(what is stored)`` in place of all stored rows."""
        while True:
            known = self.batches()
            if self._publish(known, f"replaced {uuid.uuid4().hex}", rows(self.read(known)), replaces=True):
                return

    def _publish(self, known: Sequence[Batch], batch: str, df: DataFrame, replaces: bool) -> bool:
        path = new_path()
        self._write(df.select(*self.schema.names), f"{self.folder}/{path}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.folder}/{path}").count()
        number = known[-1].number + 1 if known else 0
        entry = {"number": number, "batch": batch, "path": path, "rows": written, "replaces": replaces}
        if self._enter(number, json.dumps(entry)):
            return True
        fs, at = self._fs(path)
        fs.delete(at, True)
        return False

    def _enter(self, number: int, text: str) -> bool:
        """Whether the ledger's entry of that number is now this one."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fs, draft = self._fs(f"ledger/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        _, entry = self._fs(f"ledger/{number:012d}.json")
        plain = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, entry, plain)
        except Exception:
            if not fs.exists(entry):
                raise
            fs.delete(draft, False)
            return False
        return True

    def vacuum(self) -> int:
        """Deletes data that no entry needs, of broken loads and from before a replacement; how many folders.

        Only while nobody writes or reads older entries.
        """
        needed = {b.path for b in self._live(self.batches())}
        fs, data = self._fs("data")
        if not fs.exists(data):
            return 0
        gone = [s.getPath() for s in fs.listStatus(data) if f"data/{s.getPath().getName()}" not in needed]
        for path in gone:
            fs.delete(path, True)
        return len(gone)


def new_rows(df: DataFrame, stored: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key (in ``order``, then by all other columns) whose key is not stored.

    NULL keys are equal to each other here, so a batch that comes again under another id adds none either.
    """
    from ledgerloom.operators.cleaning import dedupe_keep_first

    rest = [c for c in df.columns if c not in keys and c not in order]
    first = dedupe_keep_first(df, keys, [*order, *rest])
    old = stored.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return first.join(old, same, "left_anti")
