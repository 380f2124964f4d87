"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of at least
``LEAST_CHARS`` code points count. Documents come in batches, largest ids first. The keys of a batch (128-bit hash, number
of documents, largest id that holds it) are sorted by hash and written as a run of level 0; when a
level has ``fan`` runs they are merged into one run of the next level, so a store of n batches has
at most ``fan`` runs on each of log(n) levels. :meth:`LineRuns.add` merge-anti-joins a new batch with the
runs and gives back its keys that no earlier batch had.

The holder of such a first key with the largest id is the one that keeps its lines, as later batches
have smaller ids; all other (document, key) pairs are repeats. After the last batch the repeats are
merge-joined with the runs: those of keys in at least ``LEAST_DOCS`` documents lose their lines.

Scale: the text is read once for the hashes and once for the result; between, only hashes move. Keys are
counted before the shuffle (a line in a third of all documents is a few rows per task) and runs hold one
row per key. Runs lie in the shared folder; nothing depends on an executor's memory. Documents without
dropped lines pass as they are.

A null or empty text is one empty line; null ids count as one document (smaller than all others), and
rows with the same id as one document whose lines are those of all its rows. Documents are counted
once however often they hold a line; then all its lines in them go. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir

LEAST_CHARS = 20
LEAST_DOCS = 3
BATCHES = 3
FAN = 2
WHITE = " \t\n\v\f\r"
NO_ID = -(1 << 63)


def key_hashes(lines: list[str], least_chars: int) -> list[bytes | None]:
    """The hash of each line's key, None for short keys."""
    hashes: list[bytes | None] = []
    for line in lines:
        key = line.strip(WHITE)
        if len(key) < least_chars:
            hashes.append(None)
        else:
            hashes.append(xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower()))
    return hashes


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, h1, h2: the distinct keys of each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = {h for h in key_hashes((text.as_py() or "").split("\n"), least_chars) if h}
                found.extend(own)
                ids.extend([key] * len(own))
            pairs = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["doc_id", "h1", "h2"]
            )

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")
    return docs.select(ids, "text").mapInArrow(rows, "doc_id long, h1 long, h2 long")


class LineRuns:
    """The store: sorted runs of (h1, h2, n_docs, keeper) by level, in a folder all executors share."""

    def __init__(self, spark: SparkSession, folder: str, fan: int = FAN):
        self.spark, self.folder, self.fan = spark, folder, fan
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        path = f"{self.folder}/level-{level}/run-{uuid.uuid4().hex}"
        rows.sortWithinPartitions("h1", "h2").write.parquet(path)
        self.levels[level].append(path)

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def merged(self) -> DataFrame | None:
        """One row per key over all runs; None while there is no run."""
        paths = [path for level in self.levels for path in level]
        return self._merge(self.spark.read.parquet(*paths)) if paths else None

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch (doc_id, h1, h2); gives its keys that are in no earlier run.

        No document may be in two batches.
        """
        keys = (
            lines.dropDuplicates(["doc_id", "h1", "h2"])
            .groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        )
        known = self.merged()
        self._write(keys, 0)
        own = self.spark.read.parquet(self.levels[0][-1])
        unseen = own if known is None else own.join(known, ["h1", "h2"], "left_anti")
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan:
            # the merged runs stay as files: readers of earlier results may still need them
            self._write(self._merge(self.spark.read.parquet(*self.levels[level])), level + 1)
            self.levels[level] = []
            level += 1
        return unseen


def _batch_of(doc_id: Column, docs: DataFrame, batches: int) -> Column:
    """The batch of an id, 0 for the largest ids; batches are ranges of ids of about equal numbers of rows."""
    shares = [k / batches for k in range(1, batches)]
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    cuts = (docs.agg(F.percentile_approx(own, shares).alias("cuts")).first().cuts or []) if shares else []
    return sum(((doc_id <= cut).cast("int") for cut in cuts), F.lit(0))


def dropped_keys(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fan: int = FAN
) -> DataFrame:
    """doc_id and the keys (their hashes) whose lines this document loses."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/line-runs-{uuid.uuid4().hex}"
    hashed = line_hashes(docs, least_chars).withColumn("batch", _batch_of(F.col("doc_id"), docs, batches))
    hashed.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema("doc_id long, h1 long, h2 long, batch int").parquet(f"{folder}/lines")
    store, repeats = LineRuns(spark, f"{folder}/runs", fan), None
    for batch in range(batches):
        own = lines.where(F.col("batch") == batch).drop("batch")
        first = store.add(own).select("h1", "h2", F.col("keeper").alias("doc_id"))
        again = own.join(first, ["h1", "h2", "doc_id"], "left_anti")
        repeats = again if repeats is None else repeats.unionByName(again)
    common = store.merged().where(F.col("n_docs") >= least_docs).select("h1", "h2")
    lost = repeats.join(common, ["h1", "h2"])
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("dropped"))


KEPT = "struct<text: string, n_lines: bigint, n_dropped: bigint>"


def dedup_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fan: int = FAN
) -> DataFrame:
    """``row`` (the document as it was) and ``kept``: its text without dropped lines, n_lines, n_dropped."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf(KEPT)
    def without_lines(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts_, drops in texts:
            out, counts, gone = [], [], []
            for text, drop in zip(texts_, drops):
                whole = text.as_py() or ""
                lines = whole.split("\n")
                lost = {np.array([d["h1"], d["h2"]], np.int64).tobytes() for d in drop.as_py() or ()}
                if lost:
                    hashes = key_hashes(lines, least_chars)
                    kept = [line for line, h in zip(lines, hashes) if h not in lost]
                    whole = "\n".join(kept)
                else:
                    kept = lines
                out.append(whole)
                counts.append(len(lines))
                gone.append(len(lines) - len(kept))
            yield pa.StructArray.from_arrays(
                [pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                names=["text", "n_lines", "n_dropped"],
            )

    lost = dropped_keys(docs, least_chars, least_docs, batches, fan).withColumnRenamed("doc_id", "line_doc_id")
    rows = docs.select(F.struct("*").alias("row"))
    own_id = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID))
    joined = rows.join(lost, own_id == F.col("line_doc_id"), "left")
    return joined.select("row", without_lines("row.text", "dropped").alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with their remaining text; texts that never had a line to lose, and nulls, stay."""
    done = dedup_lines(docs)
    text = F.when(F.col("kept.n_dropped") > 0, F.col("kept.text")).otherwise(F.col("row.text"))
    return done.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
