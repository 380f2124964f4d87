from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import day
from ledgerloom import functions as fn
from ledgerloom.functions.numbers import floor_div


def one(spark, column, **columns):
    frame = spark.range(1).withColumns({k: F.lit(v) for k, v in columns.items()})
    return frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        ("2023-01-31", "2023-02-28", 0),
        ("2023-01-31", "2023-03-31", 2),
        ("2023-01-15", "2023-01-15", 0),
        ("2024-02-29", "2025-02-28", 11),
        ("2024-02-29", "2025-03-01", 12),
        ("2022-11-10", "2024-01-09", 13),
        ("2023-06-20", "2023-04-10", -2),
        ("2023-06-20", "2023-04-25", -1),
        ("2023-06-20", "2023-06-01", 0),
    ],
)
def test_tenure_counts_whole_calendar_months(spark, start, end, months):
    got = one(spark, fn.tenure_months(F.col("a"), F.col("b")), a=day(start), b=day(end))
    assert got == months


def test_tenure_of_unknown_date_is_null(spark):
    column = fn.tenure_months(F.lit(None).cast("date"), F.lit(day("2023-01-01")))
    assert one(spark, column) is None


def test_month_of_and_month_index(spark):
    assert one(spark, fn.month_of(F.col("d")), d=day("2023-04-09")) == "2023-04"
    assert one(spark, fn.month_index(F.col("d"), 2023), d=day("2024-06-30")) == 18


@pytest.mark.parametrize(("month", "last_quarter"), [("2023-10", True), ("2023-12", True), ("2023-01", False)])
def test_quarter_four(spark, month, last_quarter):
    assert one(spark, fn.is_quarter_four(F.col("m")), m=month) is last_quarter


@pytest.mark.parametrize(
    ("score", "label"),
    [(-1, None), (0, "low"), (2, "low"), (3, "mid"), (4, "mid"), (5, "high"), (10, "high"), (11, None), (None, None)],
)
def test_bins_are_closed_on_the_right(spark, score, label):
    column = fn.bin_fixed(F.lit(score).cast("int"), (-1, 2, 4, 10), ("low", "mid", "high"))
    assert one(spark, column) == label


def test_bins_check_their_edges():
    with pytest.raises(ValueError):
        fn.bin_fixed(F.lit(1), (0, 1), ("a", "b"))
    with pytest.raises(ValueError):
        fn.bin_fixed(F.lit(1), (0, 0, 1), ("a", "b"))


def test_padded_id_keeps_long_numbers(spark):
    assert one(spark, fn.padded_id("CUST", F.lit(42), 5)) == "CUST00042"
    assert one(spark, fn.padded_id("CUST", F.lit(1234567), 5)) == "CUST1234567"


def test_full_name_is_null_when_a_part_is(spark):
    assert one(spark, fn.full_name(F.lit("Ann"), F.lit("Lee"))) == "Ann Lee"
    assert one(spark, fn.full_name(F.lit("Ann"), F.lit(None).cast("string"))) is None


def test_division_by_zero_is_null_and_ties_round_away(spark):
    ten = Decimal("10.00")
    assert one(spark, fn.percent(F.lit(ten), F.lit(Decimal("0.00")), 2)) is None
    assert one(spark, fn.ratio(F.lit(Decimal("0.25")), F.lit(Decimal("1")), 1)) == Decimal("0.3")
    assert one(spark, fn.ratio(F.lit(Decimal("-0.25")), F.lit(Decimal("1")), 1)) == Decimal("-0.3")
    assert one(spark, fn.half_even(F.lit(Decimal("0.25")), 1)) == Decimal("0.2")


def test_integer_division_is_exact_beyond_double(spark):
    assert one(spark, floor_div(F.lit(9007199254740993), F.lit(1))) == 9007199254740993
    assert one(spark, floor_div(F.lit(1), F.lit(0))) is None


def test_mean_is_rounded_once(spark):
    frame = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "v decimal(12,2)")
    assert frame.agg(fn.mean_of(F.col("v"), 2).alias("m")).first()["m"] == Decimal("0.02")
