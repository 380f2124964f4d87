import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.order_statistics import (
    ntile_ends,
    order_statistics,
    quantile_ends,
    rank_buckets,
    recency_and_rank_buckets,
)

SIZES = [1, 2, 3, 5, 7, 12, 53]


def frame(spark, n):
    rows = [(f"C{i:04d}", (i * 7919) % 4, (i * 31) % 97) for i in range(n)]
    return spark.createDataFrame(rows, "id string, a int, b bigint")


def sql_ntile(n, k):
    small, larger = divmod(n, k)
    sizes = [small + 1] * larger + [small] * (k - larger)
    return [tile + 1 for tile, size in enumerate(sizes) for _ in range(size)]


def by_order(rows, column, key):
    return [row[column] for row in sorted(rows, key=key)]


@pytest.mark.parametrize("partitions", [None, 1, 6])
@pytest.mark.parametrize("n", SIZES)
def test_ntile_of_several_measures_with_one_sort(spark, n, partitions):
    measures = {"low": F.col("a"), "high": -F.col("b")}
    rows = rank_buckets(frame(spark, n), measures, "id", ntile_ends(5), partitions).collect()
    assert by_order(rows, "low", lambda r: (r["a"], r["id"])) == sql_ntile(n, 5)
    assert by_order(rows, "high", lambda r: (-r["b"], r["id"])) == sql_ntile(n, 5)


@pytest.mark.parametrize("n", [2, 4, 7, 12, 53])
def test_rank_quantiles_match_pandas(spark, n):
    rows = rank_buckets(frame(spark, n), {"q": F.col("a")}, "id", quantile_ends(5), 3).collect()
    rows = sorted(rows, key=lambda r: r["id"])
    ranks = pd.Series([r["a"] for r in rows]).rank(method="first")
    assert [r["q"] for r in rows] == (pd.qcut(ranks, 5, labels=False) + 1).tolist()


def test_missing_values_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 1), ("d", None)], "id string, v int")
    rows = rank_buckets(df, {"t": F.col("v")}, "id", ntile_ends(4), 2).collect()
    assert {r["id"]: r["t"] for r in rows} == {"c": 1, "b": 2, "a": 3, "d": 4}


@pytest.mark.parametrize("partitions", [None, 1, 6])
@pytest.mark.parametrize("n", [11, 40, 97])
def test_mixed_buckets_match_pandas(spark, n, partitions):
    df = frame(spark, n)
    rows = recency_and_rank_buckets(df, ("v", "b"), {"r": "a"}, "id", 5, partitions).collect()
    pdf = pd.DataFrame([r.asDict() for r in rows]).sort_values("id")
    assert pdf["v"].tolist() == (pd.qcut(pdf["b"], 5, labels=False) + 1).tolist()
    assert pdf["r"].tolist() == (pd.qcut(pdf["a"].rank(method="first"), 5, labels=False) + 1).tolist()


def test_equal_edges_raise(spark):
    df = frame(spark, 30)
    with pytest.raises(Exception, match="Bin edges must be unique"):
        recency_and_rank_buckets(df, ("v", "a"), {"r": "b"}, "id", 5).collect()


def test_empty_input(spark):
    df = frame(spark, 1).limit(0)
    assert rank_buckets(df, {"q": F.col("a")}, "id", ntile_ends(5)).count() == 0
    assert recency_and_rank_buckets(df, ("v", "b"), {"r": "a"}, "id", 5).count() == 0


def test_positions_are_exact_for_a_hot_value(spark):
    df = spark.range(3000).select(
        F.format_string("C%04d", "id").alias("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v")
    )
    median = order_statistics(df, {"v": F.col("v")}, "id", {"v": [lambda n: F.floor(n / 2)]}, 8)
    row = median.first()
    expected = sorted((7 if i % 3 == 0 else i, f"C{i:04d}") for i in range(3000))[1500]
    assert (row["total"], row["v_0"]["value"], row["v_0"]["tiebreak"]) == (3000, *expected)
