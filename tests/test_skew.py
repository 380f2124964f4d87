"""One account, customer, id and amount hold a third of the rows; results stay whole."""

import random
import re
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import plan, tables
from ledgerloom.operators.cleaning import TRANSACTION_ORDER, cleaning_profile, dedupe_keep_first
from ledgerloom.operators import anomaly
from ledgerloom.plans import reports, scoring

SIZE = 3000


def skewed_rows():
    pick = random.Random(11)
    rows = []
    for i in range(SIZE):
        hot = i % 3 == 0
        account = "A0" if hot else f"A{pick.randrange(1, 60)}"
        key = "T-hot" if hot else f"T{i % 1500}"
        amount = "7.77" if hot else f"{pick.randrange(1, 90000) / 100:.2f}"
        when = pd.Timestamp("2023-01-01") + pd.Timedelta(days=pick.randrange(400))
        kind = "payment" if hot else pick.choice(["deposit", "payment", "fee"])
        status = pick.choice(["completed"] * 9 + ["failed"])
        rows.append((key, account, when.strftime("%Y-%m-%d"), kind, amount, "CAD", None, status, "Retail"))
    return rows


@pytest.fixture(scope="module")
def t(spark):
    people = [(f"C{c}", "R", "2022-01-01", False, None) for c in range(30)]
    # the hot customer owns a third of the accounts too
    held = [(f"A{a}", "C0" if a % 3 == 0 else f"C{a % 30}", f"P{a % 4}") for a in range(60)]
    bound = tables(spark, people, held, skewed_rows())
    for df in bound.named().values():
        df.cache()
    return bound


@pytest.fixture(scope="module")
def frame():
    names = ["id", "account", "day", "kind", "amount", "currency", "text", "status", "merchant"]
    rows = pd.DataFrame(skewed_rows(), columns=names)
    rows["cents"] = (rows["amount"].astype(float) * 100).round().astype(int)
    number = rows["account"].str[1:].astype(int)
    rows["customer"] = np.where(number % 3 == 0, "C0", "C" + (number % 30).astype(str))
    rows["product"] = "P" + (number % 4).astype(str)
    return rows


def first_copies(frame):
    order = ["id", "day", "account", "kind", "cents", "status"]
    return frame.sort_values(order, kind="stable").drop_duplicates("id")


def test_dedupe(t, frame):
    got = dedupe_keep_first(t.transactions, ["transaction_id"], TRANSACTION_ORDER).collect()
    want = first_copies(frame)
    assert len(got) == len(want)
    assert {(r["transaction_id"], str(r["transaction_date"]), r["status"]) for r in got} == set(
        zip(want["id"], want["day"], want["status"])
    )
    assert cleaning_profile(t.transactions).first()["duplicates_removed"] == SIZE - len(want)


def test_segments(t, frame):
    want = first_copies(frame).query("status == 'completed' and kind != 'fee'")
    want = want.groupby("customer").agg(n=("id", "count"), cents=("cents", "sum"))
    got = {r["customer_id"]: r for r in scoring.rfm_base(t).collect()}
    assert {k: (r["frequency"], int(r["monetary"] * 100)) for k, r in got.items()} == {
        k: (row["n"], row["cents"]) for k, row in want.iterrows()
    }


def test_value_profile(t, frame):
    completed = frame.query("status == 'completed'")
    got = {(r["product_name"], r["transaction_type"]): r for r in reports.transaction_values(t).collect()}
    groups = completed.groupby(["product", "kind"])["cents"]
    assert len(got) == groups.ngroups
    for key, cents in groups:
        row = got[key]
        middle = (Decimal(int(np.sort(cents)[(len(cents) - 1) // 2])) + int(np.sort(cents)[len(cents) // 2])) / 2
        assert row["txn_count"] == len(cents)
        assert row["max_amount"] == cents.max() / 100
        assert row["median_amount"] == float((middle / 100).quantize(Decimal("0.01"), "ROUND_HALF_UP"))


def test_monthly_users_and_inactivity(t, frame):
    completed = frame.query("status == 'completed'")
    mau = completed.groupby(completed["day"].str[:7])["customer"].nunique()
    assert {r["month"]: r["mau"] for r in reports.monthly_active_users(t).collect()} == mau.to_dict()
    idle = completed.groupby("customer")["id"].count()
    got = reports.churn_inactivity(t, F.to_date(F.lit("2025-01-01"))).collect()
    assert {r["customer_id"]: r["total_txns"] for r in got} == idle.to_dict()


def test_the_hot_account_is_reduced_before_it_is_joined(t, spark, tmp_path):
    """A third of the rows is one account: what meets the dimension is a few rows per task, not the rows."""
    path = str(tmp_path / "transactions")
    many = t.transactions.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("n")
    many.repartition(16).write.parquet(path)
    big = type(t)(t.customers, t.accounts, spark.read.parquet(path), t.monthly_revenue)
    report = reports.transaction_values(big)
    rows = report.collect()
    assert sum(r["txn_count"] for r in rows) == 60 * sum(r[7] == "completed" for r in skewed_rows())
    completed = big.transactions.filter("status = 'completed'")
    text = plan(anomaly.value_profile(completed, ["product_name", "transaction_type"], "amount", big.accounts, "account_id"))
    assert "rangepartitioning" not in text and "Checkpoint" not in text
    # below every join with the dimension the rows are grouped already
    for at in (m.start() for m in re.finditer(r"Join \[account_id", text)):
        assert "HashAggregate(keys=[account_id" in text[at:].split("FileScan")[0]
    single = {(r["product_name"], r["transaction_type"]): r["median_amount"] for r in reports.transaction_values(t).collect()}
    assert {(r["product_name"], r["transaction_type"]): r["median_amount"] for r in rows} == single
