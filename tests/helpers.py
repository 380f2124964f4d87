"""Small frames of the logical tables and plan text."""

from __future__ import annotations

import contextlib
import datetime
import io
from decimal import Decimal

from ledgerloom.sources.schemas import (
    ACCOUNTS,
    CUSTOMERS,
    MONTHLY_REVENUE,
    TRANSACTIONS,
    Tables,
)


def day(text: str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(text) if text else None


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def customers(spark, rows):
    """Rows of (id, region, join, churned, churn day[, score, income])."""
    full = []
    for row in rows:
        key, region, joined, churned, left, *rest = row
        score, income = rest if rest else (700, 50000)
        full.append(
            (key, "Ann", f"Lee {key}", f"{key}@example.invalid", region, 40, day(joined), churned,
             day(left), score, income)
        )
    return spark.createDataFrame(full, CUSTOMERS)


def accounts(spark, rows):
    """Rows of (id, customer, product[, status, open, close])."""
    full = []
    for row in rows:
        key, owner, product, *rest = row
        status, opened, closed = rest if rest else ("active", "2023-01-01", None)
        full.append(
            (key, owner, product, day(opened), day(closed), status, money(0), money(100))
        )
    return spark.createDataFrame(full, ACCOUNTS)


def transactions(spark, rows):
    """Rows of (id, account, day, type, amount[, currency, description, status, category])."""
    full = []
    for row in rows:
        key, account, when, kind, amount, *rest = row
        extra = (*rest, *("CAD", "Bill", "completed", "Retail")[len(rest) :])
        full.append((key, account, day(when), kind, money(amount), *extra))
    return spark.createDataFrame(full, TRANSACTIONS)


def revenue(spark, rows):
    """Rows of (month, account, customer, product, region, revenue)."""
    return spark.createDataFrame(
        [(*row[:5], money(row[5]), money(0)) for row in rows], MONTHLY_REVENUE
    )


def tables(spark, customer_rows, account_rows, transaction_rows, revenue_rows=()):
    return Tables(
        customers(spark, customer_rows),
        accounts(spark, account_rows),
        transactions(spark, transaction_rows),
        revenue(spark, revenue_rows),
    )


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain()
    return text.getvalue()


def values(df, *columns) -> set:
    return {tuple(row[c] for c in columns) for row in df.collect()}
