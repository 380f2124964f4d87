"""The split join: equal to the plain join, and no task with much more than the others."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import hot_keys
from ledgerloom.operators.hot_keys import hot_keys as found_keys
from ledgerloom.operators.hot_keys import key_summary, split_join, united

TASKS = 8


@pytest.fixture(scope="module")
def sides(spark):
    """Of the left rows a third has one key, a sixth another and a sixth none; equal rows among them."""
    pick = random.Random(4)

    def key(k):
        return 7 if k % 3 == 0 else 8 if k % 6 == 1 else None if k % 6 == 2 else pick.randrange(10, 4000)

    left = spark.createDataFrame([(key(k), f"row {k % 500}") for k in range(24_000)], "k long, a string").repartition(16)
    right = spark.createDataFrame([(k, f"of {k}") for k in [7, 8, None, *range(20, 3000)]], "k long, b string")
    return left.cache(), right.cache()


@pytest.fixture(autouse=True)
def by_shuffle(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", str(TASKS))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", sorted(hot_keys.SPLIT))
def test_equal_to_the_plain_join(sides, how):
    left, right = sides
    assert rows(split_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))
    if how in ("left", "right", "inner"):
        twice = right.union(right.limit(50))
        assert rows(split_join(twice, left, ["k"], how)) == rows(twice.join(left, "k", how))


def test_both_sides_heavy(spark):
    left = spark.range(0, 600).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.range(0, 400).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("other"))
    joined = split_join(left, right, ["k"])
    assert rows(joined) == rows(left.join(right, "k"))
    assert joined.filter("k = 'hot'").count() == 300 * 100


def test_several_key_columns_and_floats(spark):
    left = spark.createDataFrame([(0.0, "a", k) for k in range(900)] + [(float(k), "b", k) for k in range(100)], "x double, y string, n long")
    right = spark.createDataFrame([(-0.0, "a", "zero"), (5.0, "b", "five")], "x double, y string, z string")
    assert [r[2:] for r in rows(split_join(left, right, ["x", "y"]))] == [r[2:] for r in rows(left.join(right, ["x", "y"]))]
    assert split_join(left, right, ["x", "y"]).count() == 901


def test_no_task_has_more_than_twice_the_median(sides, setting):
    left, right = sides
    setting("spark.sql.adaptive.enabled", "false")

    def sizes(df):
        """Rows of the left side that each task of the join reads."""
        counted = df.groupBy(F.spark_partition_id()).count().collect()
        return sorted(r["count"] for r in counted)

    plain, split = sizes(left.join(right, "k", "left")), sizes(split_join(left, right, ["k"], "left"))
    assert sum(plain) == sum(split) == 24_000
    assert plain[-1] > 2 * plain[len(plain) // 2]
    assert split[-1] <= 2 * split[len(split) // 2]


def test_rows_without_heavy_keys_are_joined_as_they_are(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    joined = split_join(left, left.withColumn("b", F.lit(1)), ["k"])
    assert "_left" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 1000


def test_summaries_of_batches_unite(sides):
    left, right = sides
    parts = [key_summary(left.where(F.length("a") % 2 == k), ["k"], 256) for k in (0, 1)]
    whole = found_keys(united(parts[0].union(parts[1]), 256), TASKS)
    assert whole.rows == 24_000
    assert sorted(whole.slices(TASKS).values(), reverse=True)[0] == -(-8000 * hot_keys.FINENESS // 3000)
    summary = united(parts[0].union(parts[1]), 256)
    assert rows(split_join(left, right, ["k"], "left", summary=summary)) == rows(left.join(right, "k", "left"))


def test_slices_are_the_same_each_time(sides):
    left, _ = sides
    own = hot_keys._own_slice(left, None, F.lit(50)).alias("s")
    first = left.select("a", F.spark_partition_id().alias("p"), own)
    assert rows(first) == rows(first)
    # equal rows of a partition share a slice, those of others don't
    assert first.where("a = 'row 6'").select("s").distinct().count() > 3


def test_empty_sides_and_what_cannot_be_split(spark):
    left = spark.createDataFrame([], "k long, a string")
    right = spark.createDataFrame([(1, "x")], "k long, b string")
    assert split_join(left, right, ["k"]).count() == 0
    assert split_join(right, left, ["k"], "left").count() == 1
    with pytest.raises(TypeError):
        split_join(left, right.withColumn("k", F.col("k").cast("int")), ["k"])
    with pytest.raises(ValueError):
        split_join(left, right, ["k"], "full")
