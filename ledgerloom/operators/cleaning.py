"""Cleaning of the transaction fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the cleaning rules.
BASE_CURRENCY = "CAD"
RATES_TO_BASE = {"USD": Decimal("1.36")}
MISSING_TEXT = {"description": "Unknown"}
KEPT_STATUS = "completed"

# A total order over the columns: rows that tie on all of it are identical.
TRANSACTION_ORDER = (
    "transaction_date",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "status",
    "description",
    "merchant_category",
)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key group in ``order`` (NULLs last).

    Spark cuts each task's groups to one row before the shuffle, so a key with very many copies costs
    one row per task.
    """
    in_order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_copy", F.row_number().over(in_order)).filter("_copy = 1").drop("_copy")


def normalise_currency(
    df: DataFrame,
    rates: Mapping[str, Decimal] = RATES_TO_BASE,
    base: str = BASE_CURRENCY,
    amount: str = "amount",
    currency: str = "currency",
) -> DataFrame:
    """Amounts of the listed currencies in the base currency, unrounded; others and NULL stay."""
    converted, label = F.col(amount), F.col(currency)
    for code, rate in rates.items():
        listed = F.col(currency) == code
        converted = F.when(listed, F.col(amount) * F.lit(rate)).otherwise(converted)
        label = F.when(listed, base).otherwise(label)
    return df.withColumns({amount: converted, currency: label})


def fill_missing(df: DataFrame, values: Mapping[str, object] = MISSING_TEXT) -> DataFrame:
    return df.fillna(dict(values)) if values else df


def clean_transactions(
    transactions: DataFrame,
    rates: Mapping[str, Decimal] = RATES_TO_BASE,
    order: Sequence[str] = TRANSACTION_ORDER,
    missing: Mapping[str, object] = MISSING_TEXT,
) -> DataFrame:
    """First copy per id, base currency, no missing description, then completed rows only.

    The status filter comes last: a failed first copy also removes its completed later copies.
    """
    first = dedupe_keep_first(transactions, ["transaction_id"], order)
    converted = normalise_currency(first, rates)
    return fill_missing(converted, missing).filter(F.col("status") == KEPT_STATUS)


def _nulls_last(column: str) -> list[Column]:
    return [F.col(column).isNull().alias(f"{column}_missing"), F.col(column)]


def cleaning_profile(
    transactions: DataFrame,
    rates: Mapping[str, Decimal] = RATES_TO_BASE,
    order: Sequence[str] = TRANSACTION_ORDER,
) -> DataFrame:
    """What the cleaning does, in one row and one pass: rows in, removed, converted, filled, kept."""
    first = F.min(F.struct(*[part for column in order for part in _nulls_last(column)]))
    per_id = transactions.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("copies"), first.alias("row")
    )
    converted = F.col("row.currency").isin(*rates)
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(converted).alias("currency_converted"),
        F.count_if(F.col("row.description").isNull()).alias("descriptions_filled"),
        F.count_if(F.col("row.status") == KEPT_STATUS).alias("completed_kept"),
    )
