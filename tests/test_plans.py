"""Physical plans as a cluster would get them: no small-table shortcut, facts reduced before joins."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import plan, tables
from ledgerloom.operators import timeseries
from ledgerloom.operators.cleaning import TRANSACTION_ORDER, clean_transactions, dedupe_keep_first
from ledgerloom.operators.customers import held_products, inactivity_rollup
from ledgerloom.operators.ranking import global_row_number
from ledgerloom.operators.segmentation import rfm_ntile_rollup
from ledgerloom import session
from ledgerloom.operators import customers, segmentation
from ledgerloom.operators.quality import integrity_audit
from ledgerloom.plans import catalog, reports
from ledgerloom.sources import star, storage
from ledgerloom.sources.schemas import SCHEMAS, Tables

LAZY = sorted(
    set(catalog.queries())
    - {name for name in catalog.queries() if name.startswith(("stored", "ingested", "appended", "exported", "csv"))}
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty tables in their stored layout: the plan does not depend on the rows."""
    folder = str(tmp_path_factory.mktemp("stored"))
    empty = Tables(**{name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()})
    for name, df in empty.named().items():
        df.write.parquet(f"{folder}/{name}")
    return Tables(**{name: spark.read.schema(s).parquet(f"{folder}/{name}") for name, s in SCHEMAS.items()})


@pytest.fixture(autouse=True)
def no_broadcast(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")


def scan_columns(text, table):
    found = re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\]", text)
    return [{c.split("#")[0] for c in columns.split(",")} for columns in found]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_uses_python_or_a_cross_join(spark, name):
    text = plan(catalog.queries()[name](spark, "/root/testdata/sf0.001"))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_copies_are_cut_before_the_shuffle(stored):
    text = plan(dedupe_keep_first(stored.transactions, ["transaction_id"], TRANSACTION_ORDER))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < partial


def test_held_products_are_cut_before_the_shuffle(stored):
    text = plan(held_products(stored.accounts, 1))
    assert "row_number(), 2, Partial" in text
    assert text.count("Exchange") == 1


@pytest.mark.parametrize(
    "build",
    [
        lambda t: inactivity_rollup(t.transactions, t.accounts),
        lambda t: rfm_ntile_rollup(t.transactions, t.accounts),
        lambda t: timeseries.account_months(t.transactions).join(t.accounts.select("account_id", "customer_id"), "account_id"),
    ],
)
def test_facts_are_reduced_before_they_meet_a_dimension(stored, build):
    text = plan(build(stored))
    join = text.index("SortMergeJoin [account_id")
    reduced = text.index("HashAggregate(keys=[account_id", join)
    assert join < reduced < text.index("transactions]", reduced)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(timeseries.account_months(stored.transactions))
    assert "EqualTo(status,completed)" in text
    assert scan_columns(text, "transactions") == [{"account_id", "transaction_date", "status"}]
    text = plan(inactivity_rollup(stored.transactions, stored.accounts))
    assert scan_columns(text, "transactions") == [
        {"transaction_id", "account_id", "transaction_date", "status"}
    ]
    text = plan(reports.quarter_four_by_region(stored, 2023))
    assert "StringStartsWith(month,2023)" in text
    assert scan_columns(text, "monthly_revenue") == [{"month", "region", "revenue"}]


def test_one_pass_audit(stored):
    text = plan(reports.quality_audit(stored))
    assert len(scan_columns(text, "transactions")) == 1


def test_month_reports_reduce_before_the_single_partition(stored):
    for report in (reports.revenue_mom, reports.running_share, reports.region_share):
        text = plan(report(stored))
        for at in (m.start() for m in re.finditer("Exchange SinglePartition", text)):
            assert "HashAggregate(keys=[" in text[at:].split("FileScan")[0]


def test_global_rank_has_no_window_over_the_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    ranked = global_row_number(df, [F.col("v").asc(), F.col("id").asc()], "rn", partitions=5)
    text = plan(ranked)
    # the only one-task step numbers the partitions
    assert text.count("SinglePartition") == 1
    single = text[text.index("SinglePartition") :]
    assert "HashAggregate(keys=[_block" in single.splitlines()[1]
    assert "BroadcastHashJoin [_block" in text


def test_scalar_figures_are_subqueries_not_joins(stored):
    text = plan(reports.anomalies(stored))
    assert "Subquery" in text and "NestedLoop" not in text


def test_scalar_figures_run_once(spark, tmp_path):
    rows = [(f"T{i}", "A1", "2023-01-01", "deposit", 10 + i % 3) for i in range(40)]
    small = tables(
        spark,
        [("C1", "R", "2022-01-01", False, None)],
        [("A1", "C1", "P")],
        [*rows, ("big", "A1", "2023-05-05", "fee", 900)],
    )
    storage.write_tables(small, str(tmp_path))
    stored = storage.read_tables(spark, str(tmp_path))
    done = reports.anomalies(stored)
    done.collect()
    final = plan(done).split("\n+- == Initial Plan ==")[0]
    own = re.findall(r"[-+] (Reused)?Subquery", final)
    assert own.count("") == 1 and "Reused" in own


@pytest.mark.parametrize("report", [reports.rfm_ntile, reports.churn_inactivity])
def test_reports_with_a_snapshot_read_the_fact_once(stored, report, monkeypatch):
    """The roll-up holds the only scan; what follows reads the written roll-up."""
    rolled = []

    def watched(df):
        rolled.append(plan(df))
        return session.durable(df)

    for module in (customers, segmentation):
        monkeypatch.setattr(module, "durable", watched)
    last = plan(report(stored))
    scans = [len(scan_columns(text, "transactions")) for text in (*rolled, last)]
    assert sum(scans) == 1 and scans[0] == 1


def test_the_fact_is_shuffled_once_for_aggregation_and_join(stored):
    """The join on the account reuses the partitioning of the roll-up."""
    text = plan(inactivity_rollup(stored.transactions, stored.accounts))
    assert text.count("Exchange hashpartitioning(account_id") == 2  # fact, accounts
    assert text.count("Exchange") == 3  # and the customers' sums


def test_cleaning_shuffles_once(stored):
    assert plan(clean_transactions(stored.transactions)).count("Exchange") == 1


def test_layout_is_rebalanced_by_month(stored):
    clustered, by = storage._laid_out(stored.transactions, "transactions")
    assert by == ["transaction_month"]
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(clustered)


def test_the_integrity_audit_reads_each_table_once(stored):
    text = plan(integrity_audit(stored.named()))
    assert text.count("FileScan") == len(SCHEMAS)
    assert text.count("Exchange hashpartitioning") == 1


def test_the_derivation_does_not_stay_in_the_tasks_of_the_scan(spark, setting):
    """Whether orders are broadcast or not, one exchange lies between the scan and the join."""
    for threshold in ("-1", "10MB"):
        setting("spark.sql.autoBroadcastJoinThreshold", threshold)
        text = plan(star.transactions(spark, "/root/testdata/sf0.001"))
        between = text[text.index("Join") : text.index("FileScan parquet [l_orderkey")]
        assert between.count("Exchange hashpartitioning(l_orderkey") == 1
        assert "l_comment" not in text
