"""A layout for filters on any of several columns: rows in the order of interleaved bits, files skipped by their least and largest values.

Sorting by one column makes only filters on that column selective. Here each column is cut into some ranges with about equally many
rows, and rows are ordered by the bits of the ranges' numbers in turn. A file then holds a small box in all columns, and
its least and largest value of each column, kept in a table beside the files, tell which files a filter needs. With F files and d
columns a narrow filter on one of them reads about F^(1-1/d).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ranges per column, as bits of their number
BITS = 4
#: rows that the ranges are drawn from; they only decide on the layout
SAMPLE = 4096


def cuts(df: DataFrame, column: str, bits: int = BITS, sample: int = SAMPLE) -> list[Any]:
    """Values that cut a column into ``2**bits`` ranges, from a bounded number of rows drawn by hash."""
    rows = df.filter(F.col(column).isNotNull())
    total = rows.count()
    share = min(1.0, 2 * sample / max(total, 1))
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("cuts"), *df.columns), F.lit(1 << 30)) < int(share * (1 << 30)))
    values = sorted(row[0] for row in drawn.select(column).limit(sample).collect())
    places = [k * len(values) >> bits for k in range(1, 1 << bits)]
    return sorted({values[k] for k in places}) if values else []


def interleaved(ranges: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turn, the first column's highest bit first."""
    key = F.lit(0)
    for bit in range(bits - 1, -1, -1):
        for number in ranges:
            key = key * 2 + F.shiftright(number, bit).bitwiseAND(1)
    return key


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS) -> None:
    """``rows``: the table in about so many files; ``files``: their least and largest values of the columns."""
    spark = df.sparkSession
    ranges = []
    for column in columns:
        ends = cuts(df, column, bits)
        below = [F.when(F.col(column) >= F.lit(end), 1).otherwise(0) for end in ends]
        # few different values make few ranges; they use the high bits, too
        ranges.append(F.floor(sum(below, F.lit(0)) * (1 << bits) / (len(ends) + 1)).cast("int"))
    keyed = df.withColumn("_key", interleaved(ranges, bits))
    # rows of a cell that is too large for a file are spread over several by the columns themselves
    dealt = keyed.repartitionByRange(files, "_key", *columns).sortWithinPartitions("_key", *columns).drop("_key")
    dealt.write.parquet(f"{path}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    ends = [end for c in columns for end in (F.min(c).alias(f"{c}_least"), F.max(c).alias(f"{c}_most"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(*ends).coalesce(1).write.parquet(f"{path}/files")


def files_for(spark: SparkSession, path: str, ranges: Mapping[str, tuple[Any, Any]]) -> list[str]:
    """Names of the files that may hold rows with all columns in their ranges (ends included)."""
    listed = spark.read.parquet(f"{path}/files")
    for column, (low, high) in ranges.items():
        listed = listed.filter((F.col(f"{column}_most") >= F.lit(low)) & (F.col(f"{column}_least") <= F.lit(high)))
    return sorted(row.file for row in listed.select("file").collect())


def read_interleaved(spark: SparkSession, path: str, schema, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The rows with all columns in their ranges; other files aren't opened."""
    names = files_for(spark, path, ranges)
    if not names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{name}" for name in names])
    for column, (low, high) in ranges.items():
        rows = rows.filter(F.col(column).between(F.lit(low), F.lit(high)))
    return rows
