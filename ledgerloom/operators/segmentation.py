"""RFM base, scores and segments, churn points and the KPI row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import bin_fixed
from ledgerloom.functions.numbers import count_as_decimal, ratio
from ledgerloom.operators.order_statistics import (
    ntile_ends,
    rank_buckets,
    recency_and_rank_buckets,
)
from ledgerloom.session import durable

# Segment names.
CHAMPIONS, LOYAL, POTENTIAL = "Champions", "Loyal Customers", "Potential Loyalists"
AT_RISK, OTHERS = "At Risk", "Others"
SEGMENTS = (CHAMPIONS, LOYAL, POTENTIAL, AT_RISK, OTHERS)

# Risk bins and labels.
RISK_EDGES = (-1, 2, 4, 10)
RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk")

# Rounded sums fit, and their own sum still divides with eight decimals.
MONEY_SUM = "decimal(22,2)"

CUSTOMER_COLUMNS = ("first_name", "last_name", "region", "is_churned")


def rfm_segment(total: Column, r_score: Column) -> Column:
    """By total score; low totals split on recency."""
    return (
        F.when(total >= 13, CHAMPIONS)
        .when(total >= 10, LOYAL)
        .when(total >= 7, POTENTIAL)
        .when(r_score <= 2, AT_RISK)
        .otherwise(OTHERS)
    )


def rfm_base(accounts: DataFrame, cleaned: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Recency in days, number and sum of non-fee transactions per customer, from a durable roll-up.

    The default snapshot is the day after the last cleaned row of any kind, fees and unknown accounts
    included, so the roll-up keeps those too until it is written: snapshot and sums then come from one
    pass over the fact. A NULL type counts as not a fee.
    """
    not_fee = ~F.col("transaction_type").eqNullSafe(F.lit("fee"))
    per_account = cleaned.groupBy("account_id").agg(
        F.max("transaction_date").alias("last_any"),
        F.max(F.when(not_fee, F.col("transaction_date"))).alias("last_date"),
        F.count_if(not_fee).alias("rows"),
        F.count(F.when(not_fee, F.col("transaction_id"))).alias("frequency"),
        F.sum(F.when(not_fee, F.col("amount"))).alias("monetary"),
    )
    per_customer = durable(
        per_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("last_any").alias("last_any"),
            F.max("last_date").alias("last_date"),
            F.sum("rows").alias("rows"),
            F.sum("frequency").alias("frequency"),
            F.coalesce(F.sum("monetary"), F.lit(0)).alias("monetary"),
        )
    )
    if as_of is None:
        as_of = per_customer.agg(F.date_add(F.max("last_any"), 1)).scalar()
    return per_customer.filter(F.col("customer_id").isNotNull() & (F.col("rows") > 0)).select(
        "customer_id",
        F.datediff(as_of, F.col("last_date")).alias("recency"),
        "frequency",
        "monetary",
    )


def rfm_scores(
    base: DataFrame, partitions: int | None = None, duplicates: str = "raise"
) -> DataFrame:
    """Scores 1 to 5, 5 best: recency by value quantiles, frequency and monetary by rank quantiles.

    One global sort for all three. ``base`` is read twice, so it should be durable, as
    :func:`rfm_base` makes it. Many customers with the same recency can make two quantiles equal; that
    raises, or with ``duplicates="drop"`` leaves fewer recency scores, 5 still the best.
    """
    bucketed = recency_and_rank_buckets(
        base,
        ("r_bucket", "recency"),
        {"f_score": "frequency", "m_score": "monetary"},
        "customer_id",
        5,
        partitions,
        duplicates,
    )
    scored = bucketed.withColumn("r_score", 6 - F.col("r_bucket")).drop("r_bucket", "r_bucket_bins")
    return scored.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def rfm_segments(
    base: DataFrame,
    customers: DataFrame,
    partitions: int | None = None,
    duplicates: str = "raise",
) -> DataFrame:
    """Scored and labelled customers with their attributes; customers without activity are absent."""
    segment = rfm_segment(F.col("rfm_total"), F.col("r_score"))
    return (
        rfm_scores(base, partitions, duplicates)
        .withColumns({"segment": segment, "monetary": F.round("monetary", 2).cast(MONEY_SUM)})
        .join(customers.select("customer_id", *CUSTOMER_COLUMNS), "customer_id")
        .select(
            "customer_id",
            "recency",
            "frequency",
            "monetary",
            "r_score",
            "f_score",
            "m_score",
            "rfm_total",
            "segment",
            *CUSTOMER_COLUMNS,
        )
    )


def rfm_ntile_rollup(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per customer, NULL for unknown accounts: last day of any transaction, figures of the counted ones."""
    counted = (F.col("status") == "completed") & (F.col("transaction_type") != "fee")
    per_account = transactions.groupBy("account_id").agg(
        F.max("transaction_date").alias("last_any"),
        F.max(F.when(counted, F.col("transaction_date"))).alias("last_transaction"),
        F.count_if(counted).alias("rows"),
        F.count(F.when(counted, F.col("transaction_id"))).alias("frequency"),
        F.sum(F.when(counted, F.col("amount"))).alias("monetary"),
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.max("last_any").alias("last_any"),
            F.max("last_transaction").alias("last_transaction"),
            F.sum("rows").alias("rows"),
            F.sum("frequency").alias("frequency"),
            F.sum("monetary").alias("monetary"),
        )
    )


def rfm_ntile_base(transactions: DataFrame, accounts: DataFrame) -> tuple[DataFrame, Column]:
    """Last date, number and sum of completed non-fee transactions per customer; the data's last day.

    The plain report form: no currency conversion, copies included, NULL types dropped. The last day is
    that of any transaction; it is carried along in the roll-up, which is written once, so the fact is
    read once.
    """
    per_customer = durable(rfm_ntile_rollup(transactions, accounts))
    base = per_customer.filter(F.col("customer_id").isNotNull() & (F.col("rows") > 0))
    last_day = per_customer.agg(F.max("last_any")).scalar()
    return base.drop("last_any", "rows"), last_day


def rfm_ntile(
    base: DataFrame, as_of: Column, best_is_high: bool = False, partitions: int | None = None
) -> DataFrame:
    """NTILE(5) scores and segment.

    By default tile 1 holds the best customers while the segment rule expects high totals for them,
    as in the report this reproduces. ``best_is_high`` turns the scores round.
    """
    best_first = {
        "r_score": -F.unix_date("last_transaction"),
        "f_score": -F.col("frequency"),
        "m_score": -F.col("monetary"),
    }
    scored = rank_buckets(durable(base), best_first, "customer_id", ntile_ends(5), partitions)
    if best_is_high:
        scored = scored.withColumns(
            {name: 6 - F.col(name) for name in ("r_score", "f_score", "m_score")}
        )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_total", total).withColumns(
        {
            "recency_days": F.datediff(as_of, F.col("last_transaction")),
            "rfm_segment": rfm_segment(F.col("rfm_total"), F.col("r_score")),
        }
    )


def churn_points(rfm: DataFrame) -> DataFrame:
    """Risk points and label of every scored customer known not to have churned."""
    idle = F.col("recency")
    points = (
        F.when(idle > 90, 3).when(idle > 60, 2).when(idle > 30, 1).otherwise(0)
        + F.when(F.col("frequency") < 5, 2).otherwise(0)
        + F.when(F.col("r_score") <= 2, 2).otherwise(0)
        + F.when(F.col("m_score") <= 2, 1).otherwise(0)
    )
    return (
        rfm.filter(~F.col("is_churned"))
        .withColumn("risk_score", points)
        .withColumn("risk_label", bin_fixed(F.col("risk_score"), RISK_EDGES, RISK_LABELS))
    )


def kpi_summary(rfm: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    """One row of headline figures; the revenue total is a scalar subquery."""
    rows = count_as_decimal(F.count(F.lit(1)))
    total_revenue = monthly_revenue.agg(F.sum("revenue")).scalar()
    return rfm.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("segment") == CHAMPIONS).alias("champions"),
        F.count_if(F.col("segment") == AT_RISK).alias("at_risk"),
        ratio(F.sum("monetary"), rows, 2).alias("avg_monetary"),
        ratio(F.sum("recency").cast("decimal(20,0)"), rows, 1).alias("avg_recency_days"),
    ).withColumn("total_revenue", total_revenue)
