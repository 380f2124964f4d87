"""Files that a filter on one of several columns needs, and quantile summaries."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.interleaved import files_for, interleaved, read_interleaved, write_interleaved
from ledgerloom.state.quantile_sketches import quantiles, rank_bound, summaries

SCHEMA = "day int, account string, region string, amount double"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    pick = random.Random(12)
    rows = [
        (None if k % 97 == 0 else pick.randrange(1000), "A00000" if k % 3 == 0 else f"A{pick.randrange(5000):05d}", pick.choice("NESWC"), k / 2)
        for k in range(20_000)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("interleaved") / "t")
    write_interleaved(df, path, ["region", "day", "account"], 128)
    return df.cache(), path


@pytest.mark.parametrize(
    "ranges",
    [{"day": (100, 130)}, {"day": (999, 2000)}, {"account": ("A02000", "A02100")}, {"region": ("E", "E")}],
)
def test_a_filter_on_one_column_reads_under_a_third_of_the_files(spark, stored, ranges):
    df, path = stored
    total = len(files_for(spark, path, {}))
    assert total >= 100
    assert 0 < len(files_for(spark, path, ranges)) < total / 3
    rows = read_interleaved(spark, path, df.schema, ranges)
    wanted = df
    for column, (low, high) in ranges.items():
        wanted = wanted.filter(F.col(column).between(low, high))
    assert sorted(r.amount for r in rows.collect()) == sorted(r.amount for r in wanted.collect())


def test_filters_together_and_nothing(spark, stored):
    df, path = stored
    ranges = {"day": (0, 500), "account": ("A00000", "A00000"), "region": ("N", "S")}
    wanted = df.filter("day between 0 and 500 and account = 'A00000' and region between 'N' and 'S'")
    assert read_interleaved(spark, path, df.schema, ranges).count() == wanted.count() > 0
    assert read_interleaved(spark, path, df.schema, {"region": ("X", "Z")}).count() == 0
    assert read_interleaved(spark, path, df.schema, {}).count() == 20_000


def test_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    write_interleaved(df, str(tmp_path / "e"), ["day", "account"], 4)
    assert read_interleaved(spark, str(tmp_path / "e"), df.schema, {"day": (1, 2)}).count() == 0


def test_interleaved_bits(spark):
    numbers = spark.range(16).select(F.col("id").cast("int").alias("a"), (15 - F.col("id")).cast("int").alias("b"))
    rows = numbers.select("a", "b", interleaved([F.col("a"), F.col("b")], 4).alias("z")).collect()
    for a, b, z in rows:
        assert z == int("".join(x + y for x, y in zip(f"{a:04b}", f"{b:04b}")), 2)


def test_quantiles_of_united_summaries(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("month"), F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 60_000)).alias("v"))
    values = sorted(r.v for r in df.collect() if r.v is not None)
    for row in quantiles(summaries(df, "v", ["month"]), [0.01, 0.5, 0.95]).collect():
        assert row.n == len(values)
        below, upto = sum(v < row.value for v in values), sum(v <= row.value for v in values)
        assert below <= (row.share + rank_bound()) * row.n and upto >= (row.share - rank_bound()) * row.n
    halves = quantiles(summaries(df, "v", ["month"]), [0.5], (F.col("month") < 3).alias("early")).collect()
    assert sorted(r.early for r in halves) == [False, True]
    assert rank_bound() < 0.03
