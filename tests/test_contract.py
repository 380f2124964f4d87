"""Every registered query against its DuckDB SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
import check_queries
from ledgerloom.plans import catalog, oracle

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = check_queries.duck(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(oracle.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    outcome = check_queries.compare(spark, duck, FOLDER, name)
    assert outcome.startswith("OK"), outcome


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:3] == ["customer_id", "recency", "frequency"]
    assert result.count() == 150


@pytest.mark.parametrize(
    "name",
    [
        "q06_rfm_ntile",
        "q07_cross_sell",
        "q13_txn_value",
        "clean_transactions",
        "integrity_audit",
        "ntile_quintiles",
        "quantile_cut_recency",
        "rank_quintile_scores",
        "rfm_segments",
        "segment_revenue_share",
    ],
)
def test_query_spread_over_many_partitions(spark, duck, setting, name):
    """As on a cluster: no broadcast by size, no merging of small partitions."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "13")
    outcome = check_queries.compare(spark, duck, FOLDER, name)
    assert outcome.startswith("OK"), outcome
