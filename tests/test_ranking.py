import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quantiles import exact_quantiles, quantile_bucket
from ledgerloom.operators.order_statistics import global_ntile, rank_quantile_buckets
from ledgerloom.operators.ranking import global_row_number, ntile_of

SIZES = [1, 2, 4, 5, 7, 12, 53]


def frame(spark, numbers):
    return spark.createDataFrame(
        [(f"C{i:04d}", n) for i, n in enumerate(numbers)], "id string, v int"
    )


def tied(n, distinct=4):
    return [(i * 7919) % distinct for i in range(n)]


def sql_ntile(n, k):
    small, larger = divmod(n, k)
    sizes = [small + 1] * larger + [small] * (k - larger)
    return [tile + 1 for tile, size in enumerate(sizes) for _ in range(size)]


@pytest.mark.parametrize("partitions", [None, 1, 5])
@pytest.mark.parametrize("n", SIZES)
def test_ntile_matches_sql(spark, n, partitions):
    numbers = tied(n)
    got = global_ntile(frame(spark, numbers), 5, {"tile": -F.col("v")}, "id", partitions)
    tiles = {row["id"]: row["tile"] for row in got.collect()}
    ids = sorted(range(n), key=lambda i: (-numbers[i], i))
    assert [tiles[f"C{i:04d}"] for i in ids] == sql_ntile(n, 5)


@pytest.mark.parametrize("spread", [1, 7, 64])
def test_row_number_does_not_depend_on_the_input_partitioning(spark, spread):
    numbers = tied(200, 3)
    source = frame(spark, numbers).repartition(spread)
    got = global_row_number(source, [F.col("v").asc(), F.col("id").asc()], "rn", "n", 6).collect()
    expected = sorted(range(200), key=lambda i: (numbers[i], i))
    assert [r["id"] for r in sorted(got, key=lambda r: r["rn"])] == [f"C{i:04d}" for i in expected]
    assert {r["n"] for r in got} == {200}


def test_nulls_go_where_the_order_says(spark):
    source = spark.createDataFrame([("a", None), ("b", 1), ("c", 2)], "id string, v int")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = global_row_number(source, order, "rn", partitions=3).orderBy("rn").collect()
    assert [r["id"] for r in got] == ["c", "b", "a"]


@pytest.mark.parametrize("n", [2, 4, 5, 7, 12, 53, 101])
def test_rank_buckets_match_pandas(spark, n):
    numbers = tied(n)
    got = rank_quantile_buckets(frame(spark, numbers), 5, {"b": F.col("v")}, "id", 4).orderBy("id")
    ranks = pd.Series(numbers).rank(method="first")
    assert [r["b"] for r in got.collect()] == (pd.qcut(ranks, 5, labels=False) + 1).tolist()


def test_rank_bucket_of_one_row_raises(spark):
    with pytest.raises(Exception, match="Bin edges must be unique"):
        rank_quantile_buckets(frame(spark, [3]), 5, {"b": F.col("v")}, "id").collect()


def test_several_columns_take_one_sort(spark, monkeypatch):
    from ledgerloom.operators import order_statistics

    sorted_frames = []
    real = order_statistics.range_ordered
    monkeypatch.setattr(
        order_statistics, "range_ordered", lambda df, *rest: sorted_frames.append(df.columns) or real(df, *rest)
    )
    wide = frame(spark, tied(53)).withColumns({"w": F.col("v") * 3, "text": F.repeat(F.lit("x"), 100)})
    got = rank_quantile_buckets(wide, 5, {"a": F.col("v"), "b": -F.col("w")}, "id")
    assert got.count() == 53
    assert [set(columns) for columns in sorted_frames] == [{"_tie", "_measure", "_value", "_missing"}]


@pytest.mark.parametrize("partitions", [None, 5])
@pytest.mark.parametrize("n", [9, 40, 137])
def test_value_buckets_match_pandas(spark, n, partitions):
    numbers = [(i * 37) % 83 for i in range(n)]
    got = quantile_bucket(
        frame(spark, numbers), "v", 5, [5, 4, 3, 2, 1], "b", partitions=partitions
    ).orderBy("id")
    expected = pd.qcut(pd.Series(numbers), 5, labels=[5, 4, 3, 2, 1]).astype(int).tolist()
    assert [r["b"] for r in got.collect()] == expected


def test_equal_edges_raise_or_merge(spark):
    numbers = [1] * 10 + [2, 3]
    with pytest.raises(Exception, match="Bin edges must be unique"):
        quantile_bucket(frame(spark, numbers), "v", 5).collect()
    merged = quantile_bucket(frame(spark, numbers), "v", 5, name="b", duplicates="drop")
    expected = pd.qcut(pd.Series(numbers), 5, labels=False, duplicates="drop") + 1
    assert [r["b"] for r in merged.orderBy("id").collect()] == expected.tolist()


def test_bucket_options_are_checked(spark):
    source = frame(spark, [1, 2])
    for bad in ({"duplicates": "no"}, {"labels": [1]}, {"labels": [1, 2, 3, 4, 5], "duplicates": "drop"}):
        with pytest.raises(ValueError):
            quantile_bucket(source, "v", 5, **bad)


@pytest.mark.parametrize("partitions", [None, 1, 6])
def test_quantiles_match_numpy_per_group(spark, partitions):
    rng = np.random.default_rng(5)
    rows = [(["a", "b", None][i % 3], int(v)) for i, v in enumerate(rng.integers(0, 40, 300))]
    rows += [("one", 9), ("a", None), ("empty", None)]
    source = spark.createDataFrame(rows, "k string, v int")
    got = exact_quantiles(source, "v", [0, "1/4", 0.5, 1], ["k"], partitions).collect()
    assert {r["k"] for r in got} == {"a", "b", None, "one"}
    for r in got:
        numbers = [v for k, v in rows if k == r["k"] and v is not None]
        assert r["n"] == len(numbers)
        assert r["quantiles"] == pytest.approx(np.quantile(numbers, [0, 0.25, 0.5, 1]))


def test_quantiles_of_a_hot_value(spark):
    rows = [("a", 7)] * 500 + [("a", i) for i in range(20)]
    source = spark.createDataFrame(rows, "k string, v int")
    got = exact_quantiles(source, "v", ["1/2", "99/100"], ["k"], 4).first()["quantiles"]
    assert got == pytest.approx(np.quantile([v for _, v in rows], [0.5, 0.99]))


def test_empty_input(spark):
    empty = frame(spark, [1]).limit(0)
    assert global_ntile(empty, 5, {"b": F.col("v")}, "id").count() == 0
    assert rank_quantile_buckets(empty, 5, {"b": F.col("v")}, "id").count() == 0
    assert quantile_bucket(empty, "v", 5).count() == 0
    assert exact_quantiles(empty, "v", ["1/2"], ["id"]).count() == 0


def test_ntile_closed_form_for_many_sizes(spark):
    """Every position of every size up to 60 in up to 9 buckets."""
    cases = (
        spark.range(1, 61)
        .withColumnRenamed("id", "n")
        .withColumn("position", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    )
    columns = [ntile_of(F.col("position"), F.col("n"), k).alias(f"k{k}") for k in range(1, 10)]
    for row in cases.select("n", "position", *columns).collect():
        for k in range(1, 10):
            assert row[f"k{k}"] == sql_ntile(row["n"], k)[row["position"] - 1]
