"""The four logical tables: types, keys, text lengths and descriptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FEE = T.DecimalType(8, 2)
MONEY = T.DecimalType(12, 2)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


CUSTOMERS = _struct(
    ("customer_id", T.StringType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("email", T.StringType()),
    ("region", T.StringType()),
    ("age", T.IntegerType()),
    ("join_date", T.DateType()),
    ("is_churned", T.BooleanType()),
    ("churn_date", T.DateType()),
    ("credit_score", T.IntegerType()),
    ("annual_income", T.IntegerType()),
)

ACCOUNTS = _struct(
    ("account_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("product_name", T.StringType()),
    ("open_date", T.DateType()),
    ("close_date", T.DateType()),
    ("status", T.StringType()),
    ("monthly_fee", FEE),
    ("balance", MONEY),
)

TRANSACTIONS = _struct(
    ("transaction_id", T.StringType()),
    ("account_id", T.StringType()),
    ("transaction_date", T.DateType()),
    ("transaction_type", T.StringType()),
    ("amount", MONEY),
    ("currency", T.StringType()),
    ("description", T.StringType()),
    ("status", T.StringType()),
    ("merchant_category", T.StringType()),
)

MONTHLY_REVENUE = _struct(
    ("month", T.StringType()),
    ("account_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("product_name", T.StringType()),
    ("region", T.StringType()),
    ("revenue", MONEY),
    ("fee_charged", FEE),
)

# Dimensions come before the facts that point at them.
SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "monthly_revenue": MONTHLY_REVENUE,
}

PRIMARY_KEYS = {"customers": "customer_id", "accounts": "account_id"}
UNIQUE_COLUMNS = {"customers": ("email",)}
# child table, child column, parent table; the parent column is the parent's primary key
FOREIGN_KEYS = (
    ("accounts", "customer_id", "customers"),
    ("transactions", "account_id", "accounts"),
    ("monthly_revenue", "account_id", "accounts"),
    ("monthly_revenue", "customer_id", "customers"),
)

# Declared text lengths.
TEXT_LENGTHS: dict[str, dict[str, int]] = {
    "customers": {
        "customer_id": 10,
        "first_name": 50,
        "last_name": 50,
        "email": 100,
        "region": 50,
    },
    "accounts": {
        "account_id": 10,
        "customer_id": 10,
        "product_name": 50,
        "status": 10,
    },
    "transactions": {
        "transaction_id": 12,
        "account_id": 10,
        "transaction_type": 20,
        "currency": 3,
        "description": 100,
        "status": 15,
        "merchant_category": 50,
    },
    "monthly_revenue": {
        "month": 7,
        "account_id": 10,
        "customer_id": 10,
        "product_name": 50,
        "region": 50,
    },
}

# Table comments.
COMMENTS = {
    "customers": "Core customer master table",
    "accounts": "Financial product accounts per customer",
    "transactions": "All transaction events across accounts",
    "monthly_revenue": "Pre-aggregated monthly revenue per account",
}


class Named:
    """Access to the four tables by name, dimensions first."""

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}


@dataclass(frozen=True)
class Tables(Named):
    """The four logical tables as lazy DataFrames."""

    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    monthly_revenue: DataFrame
