"""Cleaning, segmentation, churn risk and the dashboard exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_number
from ledgerloom.operators import segmentation, shares
from ledgerloom.operators.cleaning import clean_transactions
from ledgerloom.session import durable
from ledgerloom.sources.schemas import Tables
from ledgerloom.sources.storage import export_reports

# The columns of the churn export.
CHURN_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "region",
    "recency",
    "frequency",
    "monetary",
    "risk_score",
    "risk_label",
)


# What segmentation reads of a transaction, in the order that picks the first copy. The full order
# goes on with texts that segmentation doesn't read; copies that differ only there are alike here.
SCORED_COLUMNS = (
    "transaction_date",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "status",
)


def rfm_base(t: Tables, as_of: Column | None = None) -> DataFrame:
    narrow = t.transactions.select("transaction_id", *SCORED_COLUMNS)
    cleaned = clean_transactions(narrow, order=SCORED_COLUMNS, missing={})
    return segmentation.rfm_base(t.accounts, cleaned, as_of)


def rfm_segments(
    t: Tables, as_of: Column | None = None, duplicates: str = "raise"
) -> DataFrame:
    """Segments of all customers with activity, churned ones included.

    Building the frame computes the customers' roll-up and writes it. Hand the result (or that of
    :func:`build_exports`) to all reports that need it instead of building it for each.
    ``duplicates="drop"`` allows equal recency quantiles.
    """
    return segmentation.rfm_segments(rfm_base(t, as_of), t.customers, duplicates=duplicates)


def churn_risk(rfm: DataFrame) -> DataFrame:
    return segmentation.churn_points(rfm).select(*CHURN_COLUMNS)


def segment_counts(rfm: DataFrame) -> DataFrame:
    return shares.value_counts(rfm, "segment")


def risk_counts(rfm: DataFrame) -> DataFrame:
    """All three labels, also those without a customer."""
    return shares.value_counts(
        segmentation.churn_points(rfm), "risk_label", labels=segmentation.RISK_LABELS
    )


def segment_revenue_share(rfm: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    """Customers and revenue per segment with their shares."""
    spent = monthly_revenue.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
    totals = (
        rfm.select("customer_id", "segment")
        .join(spent, "customer_id", "left")
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
            F.count(F.lit(1)).cast("decimal(16,0)").alias("_customers"),
        )
    )
    shared = shares.share_of_total(totals, "_customers", "customer_share")
    shared = shares.share_of_total(shared, "revenue", "revenue_share")
    return shared.select(
        "segment",
        "customers",
        as_number(F.col("customer_share")).alias("customer_share_pct"),
        as_number(F.round("revenue", 2)).alias("revenue"),
        as_number(F.col("revenue_share")).alias("revenue_share_pct"),
    ).orderBy(F.desc("revenue"), "segment")


@dataclass(frozen=True)
class Exports:
    """The four dashboard data sets."""

    rfm_segments: DataFrame
    churn_risk: DataFrame
    monthly_revenue: DataFrame
    kpi_summary: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def build_exports(
    t: Tables, as_of: Column | None = None, duplicates: str = "raise"
) -> Exports:
    """The whole chain; the segments are written once and feed the other reports."""
    rfm = durable(rfm_segments(t, as_of, duplicates))
    return Exports(
        rfm_segments=rfm,
        churn_risk=churn_risk(rfm),
        monthly_revenue=t.monthly_revenue,
        kpi_summary=segmentation.kpi_summary(rfm, t.monthly_revenue),
    )


def run_exports(
    t: Tables, folder: str, as_of: Column | None = None, duplicates: str = "raise"
) -> Exports:
    exports = build_exports(t, as_of, duplicates)
    export_reports(exports.named(), folder)
    return exports
