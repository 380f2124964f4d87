from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import accounts, day, tables, transactions, values
from ledgerloom.operators import segmentation as seg
from ledgerloom.operators.cleaning import clean_transactions
from ledgerloom.plans import reports, scoring


def scored(spark, rows):
    return spark.createDataFrame(
        [(f"C{i}", *row) for i, row in enumerate(rows)],
        "customer_id string, recency int, frequency bigint, r_score bigint, m_score bigint, is_churned boolean",
    )


@pytest.mark.parametrize(
    ("total", "r", "label"),
    [
        (15, 5, seg.CHAMPIONS),
        (13, 3, seg.CHAMPIONS),
        (12, 5, seg.LOYAL),
        (10, 2, seg.LOYAL),
        (9, 2, seg.POTENTIAL),
        (7, 2, seg.POTENTIAL),
        (6, 2, seg.AT_RISK),
        (6, 3, seg.OTHERS),
        (3, 1, seg.AT_RISK),
    ],
)
def test_segment_rule(spark, total, r, label):
    column = seg.rfm_segment(F.lit(total), F.lit(r))
    assert spark.range(1).select(column.alias("s")).first()["s"] == label


@pytest.mark.parametrize(
    ("row", "points", "label"),
    [
        ((30, 5, 3, 3, False), 0, "Low Risk"),
        ((31, 5, 3, 3, False), 1, "Low Risk"),
        ((60, 5, 3, 3, False), 1, "Low Risk"),
        ((61, 5, 3, 3, False), 2, "Low Risk"),
        ((91, 5, 3, 3, False), 3, "Medium Risk"),
        ((90, 4, 3, 3, False), 4, "Medium Risk"),
        ((91, 4, 3, 3, False), 5, "High Risk"),
        ((91, 4, 2, 2, False), 8, "High Risk"),
    ],
)
def test_churn_points(spark, row, points, label):
    got = seg.churn_points(scored(spark, [row])).first()
    assert (got["risk_score"], got["risk_label"]) == (points, label)


def test_churned_and_unknown_customers_get_no_points(spark):
    rows = [(1, 1, 1, 1, True), (1, 1, 1, 1, None), (1, 1, 1, 1, False)]
    assert values(seg.churn_points(scored(spark, rows)), "customer_id") == {("C2",)}


def rfm_rows():
    """Sixty customers with spread activity, plus fees, a NULL type, an orphan and a copy."""
    rows = []
    for c in range(60):
        for n in range(1 + (c * 7) % 11):
            when = pd.Timestamp("2023-01-01") + pd.Timedelta(days=(c * 13 + n * 5) % 300)
            currency = "USD" if (c + n) % 6 == 0 else "CAD"
            rows.append(
                (f"T{c}-{n}", f"A{c}", when.strftime("%Y-%m-%d"), "deposit", f"{10 + (c * 31 + n * 17) % 90}.25", currency)
            )
    rows.append(("fee", "A1", "2023-12-31", "fee", 1))
    rows.append(("untyped", "A2", "2023-12-01", None, "5.50"))
    rows.append(("orphan", "nowhere", "2023-12-30", "deposit", 1))
    rows.append(("T0-0", "A0", "2024-06-01", "deposit", "999.00"))
    rows.append(("only a fee", "A60", "2023-05-01", "fee", 3))
    return rows


def rfm_tables(spark):
    people = [(f"C{c:02d}", "R", "2022-01-01", c % 9 == 0, None) for c in range(61)]
    return tables(spark, people, [(f"A{c}", f"C{c:02d}", "P") for c in range(61)], rfm_rows())


def place_scores(numbers):
    """Scores 1 to 5 by place in the sorted list of (number, customer)."""
    order = sorted((number, customer) for customer, number in numbers.items())
    last = len(order) - 1
    return {customer: max(1, -(-5 * place // last)) for place, (_, customer) in enumerate(order)}


def value_scores(numbers):
    """Scores 5 (low) to 1 between the values a fifth, two fifths ... up the sorted list."""
    order = sorted(numbers.values())
    edges = []
    for fifth in range(1, 5):
        whole, part = divmod(fifth * (len(order) - 1), 5)
        edges.append(order[whole] + (order[min(whole + 1, len(order) - 1)] - order[whole]) * part / 5)
    return {customer: 5 - sum(edge < number for edge in edges) for customer, number in numbers.items()}


def expected_scores():
    earliest = {}
    for key, account, when, kind, amount, *currency in rfm_rows():
        if key not in earliest or when < earliest[key][1]:
            rate = Decimal("1.36") if currency == ["USD"] else 1
            earliest[key] = (account, when, kind, Decimal(str(amount)) * rate)
    last_day = day(max(when for _, when, _, _ in earliest.values()))
    seen, spent = {}, {}
    for account, when, kind, amount in earliest.values():
        if kind != "fee" and account != "nowhere":
            customer = f"C{int(account[1:]):02d}"
            seen.setdefault(customer, []).append(when)
            spent[customer] = spent.get(customer, 0) + amount
    recency = {c: (last_day - day(max(days))).days + 1 for c, days in seen.items()}
    often = {c: len(days) for c, days in seen.items()}
    scores = value_scores(recency), place_scores(often), place_scores(spent)
    return {c: (recency[c], often[c], spent[c], *(score[c] for score in scores)) for c in seen}


def test_segments_match_the_sorted_lists(spark):
    expected = expected_scores()
    got = scoring.rfm_segments(rfm_tables(spark)).collect()
    assert len(got) == len(expected) == 60
    for row in got:
        recency, frequency, monetary, *scores = expected[row["customer_id"]]
        assert (row["recency"], row["frequency"]) == (recency, frequency)
        assert row["monetary"] == monetary.quantize(Decimal("0.01"), "ROUND_HALF_UP")
        assert [row["r_score"], row["f_score"], row["m_score"]] == scores


def test_scores_do_not_depend_on_partitions(spark):
    t = rfm_tables(spark)
    base = scoring.rfm_base(t)
    one, many = (
        sorted(map(tuple, seg.rfm_segments(base, t.customers, p).collect())) for p in (1, 7)
    )
    assert one == many


def test_tied_recency_raises_or_merges(spark):
    """Most customers were active on the last day: quantiles of the recency are equal."""
    rows = [(f"T{c}-{n}", f"A{c}", f"2023-01-{20 if c < 12 else c:02d}", "deposit", c + n) for c in range(20) for n in range(1 + c % 3)]
    people = [(f"C{c:02d}", "R", "2022-01-01", False, None) for c in range(20)]
    t = tables(spark, people, [(f"A{c}", f"C{c:02d}", "P") for c in range(20)], rows)
    with pytest.raises(Exception, match="Bin edges must be unique"):
        scoring.rfm_segments(t).collect()
    merged = {r["customer_id"]: r["r_score"] for r in scoring.rfm_segments(t, duplicates="drop").collect()}
    days = {f"C{c:02d}": 1 if c < 12 else 21 - c for c in range(20)}
    bins = pd.qcut(pd.Series(days), 5, labels=False, duplicates="drop")
    assert merged == {c: 5 - b for c, b in bins.items()}
    exports = scoring.build_exports(t, duplicates="drop")
    assert exports.churn_risk.count() == 20 and exports.kpi_summary.count() == 1


def test_fees_set_the_snapshot_but_not_the_activity(spark):
    t = rfm_tables(spark)
    base = {r["customer_id"]: r for r in scoring.rfm_base(t).collect()}
    assert "C60" not in base
    # the fee on 31 December is the last cleaned row; C02's untyped row counts
    assert base["C02"]["recency"] == 31
    fixed = seg.rfm_base(t.accounts, clean_transactions(t.transactions), F.to_date(F.lit("2024-02-01")))
    assert {r["recency"] - base[r["customer_id"]]["recency"] for r in fixed.collect()} == {31}


def test_ntile_scores_and_their_corrected_form(spark):
    people = [(f"C{c}", "R", "2022-01-01", c == 9, None) for c in range(11)]
    t = tables(
        spark,
        people,
        [(f"A{c}", f"C{c}", "P") for c in range(11)],
        [(f"T{c}", f"A{c}", f"2023-01-{c + 1:02d}", "deposit", c + 1) for c in range(11)],
    )
    plain = {r["customer_id"]: r for r in reports.rfm_ntile(t).collect()}
    turned = {r["customer_id"]: r for r in reports.rfm_ntile(t, best_is_high=True).collect()}
    assert set(plain) == {f"C{c}" for c in range(11) if c != 9}
    assert (plain["C10"]["r_score"], turned["C10"]["r_score"]) == (1, 5)
    assert plain["C10"]["recency_days"] == 1
    for key, row in plain.items():
        assert row["m_score"] + turned[key]["m_score"] == 6


def test_kpis_and_counts(spark):
    t = rfm_tables(spark)
    rfm = scoring.rfm_segments(t)
    kpi = seg.kpi_summary(rfm, t.monthly_revenue).first()
    rows = rfm.collect()
    assert kpi["total_customers"] == len(rows)
    assert kpi["champions"] == sum(r["segment"] == seg.CHAMPIONS for r in rows)
    assert kpi["total_revenue"] is None
    assert float(kpi["avg_recency_days"]) == pytest.approx(sum(r["recency"] for r in rows) / 60, abs=0.05)
    counts = dict(values(scoring.segment_counts(rfm), "segment", "customers"))
    assert sum(counts.values()) == 60
    assert {label for (label,) in values(scoring.risk_counts(rfm), "risk_label")} == set(seg.RISK_LABELS)


def test_segment_revenue_share(spark):
    rfm = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Y")], "customer_id string, segment string")
    revenue = spark.createDataFrame(
        [("a", Decimal("30")), ("a", Decimal("30")), ("c", Decimal("40")), ("z", Decimal("9"))],
        "customer_id string, revenue decimal(12,2)",
    )
    got = scoring.segment_revenue_share(rfm, revenue)
    assert [tuple(r) for r in got.collect()] == [("X", 2, 66.7, 60.0, 60.0), ("Y", 1, 33.3, 40.0, 40.0)]


def test_missing_types_are_no_fee_here_but_drop_out_of_the_plain_report(spark):
    rows = [("T1", "A1", "2023-01-01", None, 1), ("T2", "A1", "2023-01-02", "fee", 1)]
    held = accounts(spark, [("A1", "C1", "P")])
    txns = transactions(spark, rows)
    assert seg.rfm_base(held, txns).first()["frequency"] == 1
    assert seg.rfm_ntile_base(txns, held)[0].count() == 0
    assert day("2023-01-03") > day("2023-01-02")
