"""The four logical tables derived from star-schema parquet (orders, line items, customers).

Everything stays lazy and declarative, so a report only scans the columns it needs. ``nation`` and
``region`` are the only sides small by nature; no join carries a broadcast hint, Spark decides from
file sizes and run-time statistics.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import ACCOUNTS, CUSTOMERS, FEE, MONEY, Named

# Fixed values of the binding.
CHURN_CUTOFF = "2000-08-01"
PRODUCTS = ("Savings Account", "Investment Account", "Credit Card", "Personal Loan", "Crypto Wallet")
PRODUCT_FEES = {"Investment Account": Decimal("9.99"), "Personal Loan": Decimal("29.99")}
MERCHANTS = ("Retail", "Food & Drink", "Travel", "Entertainment", "Healthcare", "Other")


# Declared, so that opening a table reads no file footer.
STAR_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double"
    ),
    "events": "event_id bigint, user_id bigint, value double",
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """``values[index]``, NULL past the end."""
    return F.get(F.array(*[F.lit(value) for value in values]), index.cast("int"))


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = (
        star_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min("o_orderdate").cast("date").alias("first_order"),
            F.max("o_orderdate").cast("date").alias("last_order"),
        )
    )
    places = star_table(spark, sf_dir, "nation").join(
        star_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey")
    churned = F.coalesce(F.col("last_order") < F.to_date(F.lit(CHURN_CUTOFF)), F.lit(False))
    return (
        star_table(spark, sf_dir, "customer")
        .join(span, "c_custkey", "left")  # customers without orders have no dates
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key,
            "c_acctbal",
            F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("CUST")).alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.substr(F.col("c_name"), F.lit(10)).alias("last_name"),
            F.concat(F.lit("user"), key, F.lit("@example.invalid")).alias("email"),
            F.col("r_name").alias("region"),
            (22 + key % 46).cast("int").alias("age"),
            F.col("first_order").alias("join_date"),
            churned.alias("is_churned"),
            F.when(churned & (key % 50 != 0), F.col("last_order")).alias("churn_date"),
            (580 + (key * 7919) % 270).cast("int").alias("credit_score"),
            (35000 + (key * 104729) % 185000).cast("int").alias("annual_income"),
        )
    )


def _account_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with the owner's region: one to three per customer."""
    slot = F.col("slot")
    product = _pick((F.col("c_custkey") + 2 * slot) % len(PRODUCTS), PRODUCTS)
    fee = F.lit(Decimal("0"))
    for name, charge in PRODUCT_FEES.items():
        fee = F.when(F.col("product_name") == name, F.lit(charge)).otherwise(fee)
    return (
        _customer_base(spark, sf_dir)
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("c_custkey") % 3)))
        .withColumns(
            {
                "account_number": F.col("c_custkey") * 3 + slot,
                "account_id": F.concat(F.lit("ACC"), F.col("c_custkey") * 3 + slot),
                "product_name": product,
                "open_date": F.col("join_date"),
                "close_date": F.col("churn_date"),
                "status": F.when(F.col("is_churned"), "closed").otherwise("active"),
                "balance": F.col("c_acctbal").cast(MONEY),
            }
        )
        .withColumn("monthly_fee", fee.cast(FEE))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_base(spark, sf_dir).select(*CUSTOMERS.names)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_base(spark, sf_dir).select(*ACCOUNTS.names)


def _transaction_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order: account number, date and amount next to the raw columns.

    Line items are dealt by order first, as the join by shuffle needs them anyway. Where orders are broadcast, this keeps
    the derivation from staying in the scan's tasks, of which files with few row groups have few.
    """
    gross = F.col("l_extendedprice").cast(MONEY) * F.col("l_quantity").cast("decimal(4,0)")
    owner = F.col("o_custkey")
    return (
        star_table(spark, sf_dir, "lineitem")
        .repartition("l_orderkey")
        .join(star_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(
            {
                "account_number": owner * 3 + F.col("l_linenumber") % (owner % 3 + 1),
                "transaction_date": F.col("o_orderdate").cast("date"),
                "amount": F.round(gross * F.lit(Decimal("0.02")), 2).cast(MONEY),
            }
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("l_partkey") % 20
    outcome = (F.col("l_partkey") + F.col("l_suppkey")) % 100
    return _transaction_base(spark, sf_dir).select(
        F.concat(F.lit("TXN"), "l_orderkey", F.lit("-"), "l_linenumber").alias("transaction_id"),
        F.concat(F.lit("ACC"), "account_number").alias("account_id"),
        "transaction_date",
        F.when(kind == 0, "fee")
        .when(kind == 1, "interest")
        .when(kind <= 4, "payment")
        .when(kind <= 8, "transfer")
        .when(kind <= 13, "withdrawal")
        .otherwise("deposit")
        .alias("transaction_type"),
        "amount",
        F.when(F.col("l_suppkey") % 14 == 0, "USD").otherwise("CAD").alias("currency"),
        F.when(F.col("l_partkey") % 7 != 0, "Online Transfer").alias("description"),
        F.when(outcome < 92, "completed")
        .when(outcome < 97, "pending")
        .otherwise("failed")
        .alias("status"),
        _pick(F.col("l_suppkey") % 7, MERCHANTS).alias("merchant_category"),
    )


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up per account and month.

    The fact is reduced before it meets the dimension, on fixed-width keys; ids and months become text
    afterwards.
    """
    per_account_month = (
        _transaction_base(spark, sf_dir)
        .groupBy("account_number", F.trunc("transaction_date", "MM").alias("first_day"))
        .agg(F.sum("amount").alias("spent"))
    )
    return per_account_month.join(_account_base(spark, sf_dir), "account_number").select(
        F.date_format("first_day", "yyyy-MM").alias("month"),
        "account_id",
        "customer_id",
        "product_name",
        "region",
        F.round(F.col("spent") * F.lit(Decimal("0.01")), 2).cast(MONEY).alias("revenue"),
        F.col("monthly_fee").alias("fee_charged"),
    )


class StarTables(Named):
    """The logical tables, each built when a report first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._source = (spark, sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(*self._source)

    @cached_property
    def accounts(self) -> DataFrame:
        return accounts(*self._source)

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions(*self._source)

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return monthly_revenue(*self._source)
