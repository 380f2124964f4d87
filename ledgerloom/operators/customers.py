"""Roll-ups from account grain to customer grain.

Facts are always aggregated per account before they meet a dimension: partial aggregation shrinks a
hot account to one row per task, and the join that follows has unique keys on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_of, tenure_months
from ledgerloom.functions.numbers import mean_of
from ledgerloom.session import durable


def next_day(transactions: DataFrame, day: str = "transaction_date") -> Column:
    """The day after the last one in the data, as a scalar subquery over one column."""
    return transactions.agg(F.date_add(F.max(day), 1)).scalar()


def held_products(
    accounts: DataFrame,
    most: int,
    customer: str = "customer_id",
    account: str = "account_id",
    product: str = "product_name",
) -> DataFrame:
    """Customers with at most ``most`` accounts: their number and the sorted product names.

    Only the first ``most + 1`` accounts of a customer are kept, before the shuffle; that is enough
    to tell who has more.
    """
    in_order = Window.partitionBy(customer).orderBy(
        F.col(product).asc_nulls_last(), F.col(account).asc()
    )
    few = (
        accounts.filter(F.col(account).isNotNull())
        .select(customer, account, product)
        .withColumn("_place", F.row_number().over(in_order))
        .filter(F.col("_place") <= most + 1)
    )
    return (
        few.groupBy(customer)
        .agg(
            F.count(account).alias("product_count"),
            F.array_join(F.sort_array(F.collect_list(product)), ", ").alias("products_held"),
        )
        .filter(F.col("product_count") <= most)
    )


def lifetime_value(monthly_revenue: DataFrame) -> DataFrame:
    """Revenue and number of distinct products per customer, ready to join with customers."""
    return monthly_revenue.groupBy("customer_id").agg(
        F.sum("revenue").alias("lifetime_revenue"),
        F.countDistinct("product_name").alias("products_held"),
    )


def churn_profile(customers: DataFrame) -> DataFrame:
    """Per month of churn: how many, and their mean score, income and whole months as customer."""
    months = tenure_months(F.col("join_date"), F.col("churn_date"))
    left = customers.filter(F.col("is_churned") & F.col("churn_date").isNotNull())
    return left.groupBy(month_of(F.col("churn_date")).alias("churn_month")).agg(
        F.count(F.lit(1)).alias("churned_customers"),
        mean_of(F.col("credit_score").cast("decimal(10,0)"), 0).alias("avg_credit_score"),
        mean_of(F.col("annual_income").cast("decimal(10,0)"), 0).alias("avg_income"),
        mean_of(months.cast("decimal(10,0)"), 1).alias("avg_months_as_customer"),
    )


def inactivity_rollup(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per customer, NULL for unknown accounts: last day of any transaction, last and number of completed ones."""
    completed = F.col("status") == "completed"
    per_account = transactions.groupBy("account_id").agg(
        F.max("transaction_date").alias("last_any"),
        F.max(F.when(completed, F.col("transaction_date"))).alias("last_txn_date"),
        F.count_if(completed).alias("rows"),
        F.count(F.when(completed, F.col("transaction_id"))).alias("total_txns"),
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("last_any").alias("last_any"),
            F.max("last_txn_date").alias("last_txn_date"),
            F.sum("rows").alias("rows"),
            F.sum("total_txns").alias("total_txns"),
        )
    )


def inactivity(transactions: DataFrame, accounts: DataFrame) -> tuple[DataFrame, Column]:
    """Last completed transaction and number of them per customer; the last day of any transaction.

    The last day is carried along in the roll-up, which is written once, so the fact is read once.
    """
    per_customer = durable(inactivity_rollup(transactions, accounts))
    known = per_customer.filter(F.col("customer_id").isNotNull() & (F.col("rows") > 0))
    last_day = per_customer.agg(F.max("last_any")).scalar()
    return known.drop("last_any", "rows"), last_day


# Fixed values of the inactivity labels.
HIGH, MEDIUM, LOW, HEALTHY = "High Risk 🔴", "Medium Risk 🟡", "Low Risk 🟢", "Healthy ✅"


def inactivity_label(days: Column, transactions: Column) -> Column:
    """First rule that holds: long idle with little history is high, any idle month at least low."""
    return (
        F.when((days > 90) & (transactions < 10), HIGH)
        .when((days > 60) & (transactions < 20), MEDIUM)
        .when(days > 30, LOW)
        .otherwise(HEALTHY)
    )
