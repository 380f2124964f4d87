"""Month series: totals, change, running share, trend, retention and the month spine.

Windows without partition keys run on one task. They are used here only after grouping by period, on
one row per month, whatever the size of the fact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_of
from ledgerloom.functions.numbers import count_as_decimal, percent

# Fixed values of the trend labels.
GROWING, DECLINING, STABLE = "📈 Growing", "📉 Declining", "➡️ Stable"


def period_totals(df: DataFrame, *by: str, value: str = "revenue", name: str = "total") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(name))


def period_change(
    totals: DataFrame,
    period: str = "month",
    value: str = "total",
    offset: int = 1,
    direction: str = "previous",
) -> DataFrame:
    """Adds ``<value>_previous`` or ``<value>_next``, the difference to it and the change in percent.

    With ``next`` the change leads from this period to the following one.
    """
    if direction not in ("previous", "next"):
        raise ValueError("direction must be 'previous' or 'next'")
    in_order = Window.orderBy(period)
    shift = F.lag if direction == "previous" else F.lead
    other = f"{value}_{direction}"
    shifted = totals.withColumn(other, shift(value, offset).over(in_order))
    early, late = (other, value) if direction == "previous" else (value, other)
    change = F.col(late) - F.col(early)
    return shifted.withColumns(
        {"change": change, "change_pct": percent(change, F.col(early), 2)}
    )


def running_share(totals: DataFrame, period: str = "month", value: str = "total") -> DataFrame:
    """Adds the running total and its percentage of the grand total."""
    upto = Window.orderBy(period).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(1))
    return totals.withColumn("cumulative", F.sum(value).over(upto)).withColumn(
        "cumulative_pct", percent(F.col("cumulative"), F.sum(value).over(everything), 1)
    )


def first_last_trend(
    totals: DataFrame,
    key: str = "product_name",
    period: str = "month",
    value: str = "total",
    up: Decimal = Decimal("1.10"),
    down: Decimal = Decimal("0.90"),
) -> DataFrame:
    """First and last period's total per key, growth in percent and a trend label.

    ``totals`` holds one row per key and period, so this is a small aggregation and needs no window.
    """
    ends = totals.groupBy(key).agg(
        F.min_by(value, period).alias("first_total"), F.max_by(value, period).alias("last_total")
    )
    first, last = F.col("first_total"), F.col("last_total")
    return ends.withColumns(
        {
            "growth_pct": percent(last - first, first, 1),
            "trend": F.when(last > first * F.lit(up), GROWING)
            .when(last < first * F.lit(down), DECLINING)
            .otherwise(STABLE),
        }
    )


def up_to_period(totals: DataFrame, last: str | None, period: str = "month") -> DataFrame:
    """Without the periods after ``last``; all of them if that is None."""
    return totals if last is None else totals.filter(F.col(period) <= last)


def account_months(transactions: DataFrame) -> DataFrame:
    """Distinct (account, month) with a completed transaction.

    This is the small grain that MAU and retention join on; a hot account shrinks to its months
    before any join. The month travels as a date and becomes text afterwards.
    """
    return (
        transactions.filter(F.col("status") == "completed")
        .select("account_id", F.trunc("transaction_date", "MM").alias("month"))
        .distinct()
        .withColumn("month", month_of(F.col("month")))
    )


def active_by_period(activity: DataFrame, period: str = "month", key: str = "customer_id") -> DataFrame:
    """Distinct keys per period."""
    return activity.groupBy(period).agg(F.countDistinct(key).alias("active"))


def retention(
    members: DataFrame,
    activity: DataFrame,
    cohort: str = "cohort_month",
    active: str = "active_month",
    key: str = "customer_id",
) -> DataFrame:
    """Cohort size, active members and their share for every cohort and active period.

    ``members`` holds (key, cohort), all of which count for the size; ``activity`` holds
    (key, cohort, active).
    """
    sizes = members.groupBy(cohort).agg(F.count(F.lit(1)).alias("cohort_size"))
    seen = activity.groupBy(cohort, active).agg(F.countDistinct(key).alias("active_members"))
    share = percent(
        count_as_decimal(F.col("active_members")), count_as_decimal(F.col("cohort_size")), 1
    )
    return seen.join(sizes, cohort).withColumn("retention_pct", share)


def month_spine(
    df: DataFrame,
    open_date: str = "open_date",
    close_date: str = "close_date",
    end: Column | None = None,
) -> DataFrame:
    """One row per month of each ``[open, close]`` life, from the data's dates: no range join.

    Open rows run to ``end`` (a date; default: the latest date in either column). Rows closed before
    the month they opened in have no month.
    """
    if end is None:
        latest = df.agg(F.greatest(F.max(open_date), F.max(close_date))).scalar()
        end = latest
    first = F.trunc(open_date, "MM")
    last = F.trunc(F.coalesce(F.col(close_date), F.lit(end)), "MM")
    return (
        df.withColumns({"_first": first, "_last": last})
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn(
            "_day", F.explode(F.sequence("_first", "_last", F.expr("interval 1 month")))
        )
        .withColumn("month", month_of(F.col("_day")))
        .drop("_first", "_last", "_day")
    )


def active_accounts_by_month(accounts: DataFrame, end: Column | None = None) -> DataFrame:
    """Accounts open at some time in each month.

    Counted per (open month, close month) first, so the expansion grows with pairs of months, not
    with accounts.
    """
    lives = (
        accounts.filter(F.col("open_date").isNotNull())
        .select(
            F.trunc("open_date", "MM").alias("open_date"),
            F.trunc("close_date", "MM").alias("close_date"),
        )
        .groupBy("open_date", "close_date")
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    return month_spine(lives, end=end).groupBy("month").agg(
        F.sum("accounts").alias("active_accounts")
    )
