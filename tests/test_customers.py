import pytest
from pyspark.sql import functions as F

from helpers import accounts, customers, day, revenue, tables, values
from ledgerloom.operators import customers as ops
from ledgerloom.operators import shares
from ledgerloom.plans import reports


def test_at_most_n_products(spark):
    rows = [
        ("A1", "one", "Savings"),
        ("A2", "two", "Savings"),
        ("A3", "two", "Credit"),
        *[(f"B{i}", "many", f"P{i % 3}") for i in range(50)],
    ]
    held = accounts(spark, rows)
    assert values(ops.held_products(held, 1), "customer_id", "products_held") == {("one", "Savings")}
    two = ops.held_products(held, 2)
    assert values(two, "customer_id", "product_count", "products_held") == {
        ("one", 1, "Savings"),
        ("two", 2, "Credit, Savings"),
    }


def test_cross_sell_looks_at_active_accounts_and_ranks_by_score(spark):
    t = tables(
        spark,
        [
            ("C1", "R", "2023-01-01", False, None, 700, 1),
            ("C2", "R", "2023-01-01", False, None, 800, 1),
            ("C3", "R", "2023-01-01", True, None, 849, 1),
            ("C4", "R", "2023-01-01", False, None, 800, 1),
        ],
        [
            ("A1", "C1", "P"),
            ("A2", "C1", "Q", "closed", "2023-01-01", None),
            ("A3", "C2", "P"),
            ("A4", "C3", "P"),
            ("A5", "C4", "P"),
        ],
        [],
    )
    got = [r["customer_id"] for r in reports.cross_sell(t).collect()]
    assert got == ["C2", "C4", "C1"]
    assert [r["customer_id"] for r in reports.cross_sell(t, top=1).collect()] == ["C2"]


def test_churn_profile(spark):
    people = customers(
        spark,
        [
            ("C1", "R", "2023-01-31", True, "2023-02-28", 600, 100),
            ("C2", "R", "2022-02-28", True, "2023-02-28", 601, 101),
            ("C3", "R", "2023-06-20", True, "2023-04-10", 650, 90),
            ("undated", "R", "2023-01-01", True, None, 1, 1),
            ("stays", "R", "2023-01-01", False, "2023-02-01", 1, 1),
        ],
    )
    got = {tuple(float(v) if i else v for i, v in enumerate(r)) for r in ops.churn_profile(people).collect()}
    assert got == {("2023-02", 2, 601, 101, 6.0), ("2023-04", 1, 650, 90, -2.0)}


@pytest.mark.parametrize(
    ("days", "count", "label"),
    [
        (30, 1, ops.HEALTHY),
        (31, 1, ops.LOW),
        (61, 19, ops.MEDIUM),
        (61, 20, ops.LOW),
        (91, 9, ops.HIGH),
        (91, 10, ops.MEDIUM),
        (91, 19, ops.MEDIUM),
        (91, 20, ops.LOW),
    ],
)
def test_inactivity_rules(spark, days, count, label):
    column = ops.inactivity_label(F.lit(days), F.lit(count))
    assert spark.range(1).select(column.alias("x")).first()["x"] == label


def test_inactivity_report(spark):
    t = tables(
        spark,
        [("C1", "R", "2023-01-01", False, None), ("C2", "R", "2023-01-01", True, None)],
        [("A1", "C1", "P"), ("A2", "C2", "P"), ("A3", "C1", "P")],
        [
            ("T1", "A1", "2023-01-01", "fee", 1),
            ("T2", "A3", "2023-01-31", "deposit", 1),
            ("T3", "A1", "2023-03-02", "deposit", 1, "CAD", "x", "failed"),
            ("T4", "A2", "2023-01-01", "deposit", 1),
        ],
    )
    got = reports.churn_inactivity(t).collect()
    assert [(r["customer_id"], r["last_txn_date"], r["days_inactive"], r["total_txns"]) for r in got] == [
        ("C1", day("2023-01-31"), 31, 2)
    ]
    assert reports.churn_inactivity(t, F.to_date(F.lit("2023-03-02"))).count() == 0


def test_lifetime_value_breaks_ties_by_customer(spark):
    t = tables(
        spark,
        [(c, "R", "2023-01-01", c == "gone", None) for c in ("b", "a", "c", "gone")],
        [],
        [],
        [
            ("2023-01", "A", "b", "P", "R", 5),
            ("2023-02", "A", "b", "Q", "R", 5),
            ("2023-01", "A", "a", "P", "R", 10),
            ("2023-01", "A", "c", "P", "R", 3),
            ("2023-01", "A", "gone", "P", "R", 99),
        ],
    )
    got = reports.top_lifetime_value(t, top=2).collect()
    assert [(r["customer_id"], r["lifetime_revenue"], r["products_held"]) for r in got] == [
        ("a", 10.0, 1),
        ("b", 10.0, 2),
    ]


def test_region_share(spark):
    rows = [
        ("2023-01", "A", "C1", "P", "East", 10),
        ("2023-01", "A", "C2", "P", "East", 20),
        ("2023-02", "A", "C1", "P", "East", 30),
        ("2023-01", "A", "C3", "P", "West", 30),
    ]
    got = values(
        reports.region_share(tables(spark, [], [], [], rows)),
        "region", "total_revenue", "revenue_share_pct", "unique_customers", "revenue_per_customer",
    )
    assert got == {("East", 60.0, 66.7, 2, 30.0), ("West", 30.0, 33.3, 1, 30.0)}


def test_label_counts_can_show_empty_labels(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "label string")
    got = [tuple(r) for r in shares.value_counts(df, "label", labels=["a", "b", "c"]).collect()]
    assert got == [("b", 2), ("a", 1), ("c", 0)]
    assert [tuple(r) for r in shares.value_counts(df, "label").collect()] == [("b", 2), ("a", 1)]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "North"), ("b", None)], "k string, region string")
    got = shares.lookup_with_default(df, dim, "k", "region", "South")
    assert values(got, "k", "region") == {
        ("a", "North"), ("b", "South"), ("c", "South"), (None, "South"),
    }


def test_single_product_share(spark):
    t = tables(
        spark,
        [(c, "R", "2023-01-01", c == "gone", None) for c in ("one", "two", "gone", "none")],
        [("A1", "one", "P"), ("A2", "two", "P"), ("A3", "two", "Q"), ("A4", "gone", "P")],
        [],
    )
    assert tuple(reports.single_product_share(t).first()) == (2, 1, 50.0)


def test_churn_window(spark):
    t = tables(
        spark,
        [
            ("in", "R", "2023-01-01", True, "2023-04-10"),
            ("before", "R", "2022-01-01", True, "2023-03-31"),
            ("after", "R", "2022-01-01", True, "2023-06-01"),
            ("undated", "R", "2022-01-01", True, None),
            ("stays", "R", "2022-01-01", False, None),
            ("late joiner", "R", "2023-08-01", False, None),
        ],
        [],
        [],
    )
    got = reports.churn_rate_window(t, "2023-04-01", "2023-05-31").first().asDict()
    assert got == {
        "eligible_customers": 4,
        "churned_in_window": 1,
        "all_customers": 6,
        "churned_elsewhere": 3,
        "window_churn_pct": 25.0,
        "other_churn_pct": 50.0,
    }


def test_growth_has_a_total_line(spark):
    rows = [
        ("2023-01", "A", "C", "P", "R", 100),
        ("2023-01", "A", "C", "Q", "R", 100),
        ("2023-02", "A", "C", "P", "R", 150),
        ("2023-02", "A", "C", "Q", "R", 70),
        ("2023-03", "A", "C", "Q", "R", 1),
    ]
    got = reports.product_mix_growth(tables(spark, [], [], [], rows))
    assert values(got, "product_name", "growth_pct") == {
        ("P", 50.0), ("Q", -99.0), ("All products", -99.5),
    }
    until = reports.product_mix_growth(tables(spark, [], [], [], rows), "2023-02")
    assert values(until, "product_name", "growth_pct") == {
        ("P", 50.0), ("Q", -30.0), ("All products", 10.0),
    }


def test_trend_takes_the_last_month_of_each_product(spark):
    rows = [(f"2023-0{month}", "A", "C", "P", "R", value) for month, value in ((1, 100), (2, 100), (3, 300))]
    rows.append(("2023-02", "A", "C", "single", "R", 40))
    got = reports.product_trend(tables(spark, [], [], [], rows))
    assert values(got, "product_name", "last_month_revenue", "total_growth_pct", "trend") == {
        ("P", 300.0, 200.0, "📈 Growing"), ("single", 40.0, 0.0, "➡️ Stable"),
    }


def test_region_fourth_quarter_per_customer(spark):
    rows = [
        ("2023-10", "A", "C1", "P", "East", 10),
        ("2023-12", "A", "C1", "P", "East", 20),
        ("2023-11", "A", "C2", "P", "East", 30),
        ("2023-09", "A", "C3", "P", "East", 99),
        ("2022-11", "A", "C3", "P", "East", 99),
    ]
    got = reports.region_q4_per_customer(tables(spark, [], [], [], rows), 2023)
    assert [tuple(r) for r in got.collect()] == [("East", 60.0, 2, 30.0)]


def test_chart_data(spark):
    rows = [("2023-02", "A", "C", "P", "W", 3), ("2023-01", "A", "C", "Q", "E", 1), ("2023-01", "A", "C", "P", "E", 1)]
    t = tables(spark, [], [], [], rows)
    assert [tuple(r) for r in reports.revenue_by(t, "month").collect()] == [("2023-01", 2.0), ("2023-02", 3.0)]
    by_region = reports.revenue_by(t, "region", ascending_by_value=True)
    assert [tuple(r) for r in by_region.collect()] == [("E", 2.0), ("W", 3.0)]
    assert [r[0] for r in reports.product_catalogue(t).collect()] == ["P", "Q"]
    assert revenue(spark, rows).count() == 3
