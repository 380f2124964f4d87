"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a longest run of anything but ASCII white space. ``bytes.split()`` splits the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: what lies between words
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def texts_in_parts(texts: pa.Array, most_bytes: int) -> Iterator[list[str]]:
    """The texts of an Arrow array in order, as lists of at most ``most_bytes`` (or one text).

    Bounds the memory of vectorised work: a batch of long texts is worked off piece by piece.
    """
    part: list[str] = []
    size = 0
    for scalar in texts:
        text = scalar.as_py() or ""
        if part and size + len(text) > most_bytes:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


#: steps of the hash that draws samples
_STEPS = 1 << 30


def drawn(key: Column, wanted: int, total: int) -> Column:
    """A condition that a hash of ``key`` meets for about ``wanted`` of ``total`` rows, the same ones each time.

    Cuts a table before rows are ordered, so that what meets in one task doesn't grow with the table.
    """
    share = _STEPS if wanted >= total else wanted * _STEPS // total
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(_STEPS)) < share


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, eligible: Column, limits: dict[int, int]
) -> list[tuple[str, int]]:
    """Texts with their label, at most ``limits[y]`` rows of each label ``y``.

    ``eligible`` is a condition on ``doc_id``. Which rows are taken depends on hashes of the ids only.
    Several labels of one document count as their largest; null labels and ids don't count.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(*limits) & eligible)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    order = (F.md5(F.col("doc_id").cast("string")), F.col("doc_id"))
    there = {row.y: row["count"] for row in known.groupBy("y").count().collect()}  # a row for each label
    chosen = None
    for y, limit in limits.items():
        some = known.where((F.col("y") == y) & drawn(F.col("doc_id"), 2 * limit, there.get(y, 0)))
        part = some.orderBy(*order).limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most sum(limits) rows of two numbers: the bound of this broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    found = sorted((r.doc_id, r.text or "", r.y) for r in rows.dropDuplicates(["doc_id"]).collect())
    return [(text, y) for _, text, y in found]
