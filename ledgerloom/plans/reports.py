"""The fifteen business reports and the chart data.

Each takes the logical tables and returns the finished report: rounded, typed for output and sorted.
Top-k reports append the key to the sort so that ties have one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_number, full_name, is_quarter_four, month_of, percent, ratio
from ledgerloom.functions.numbers import count_as_decimal
from ledgerloom.operators import anomaly, customers, quality, segmentation, shares, timeseries
from ledgerloom.sources.schemas import Tables


def _money(column: str | Column, name: str | None = None, places: int = 2) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    rounded = as_number(F.round(value, places))
    return rounded.alias(name or column)


def _name() -> Column:
    return full_name(F.col("first_name"), F.col("last_name")).alias("customer_name")


def revenue_mom(t: Tables) -> DataFrame:
    totals = timeseries.period_totals(t.monthly_revenue, "month")
    return (
        timeseries.period_change(totals)
        .select(
            "month",
            _money("total", "total_revenue"),
            _money("change", "mom_change"),
            as_number(F.col("change_pct")).alias("mom_pct_change"),
        )
        .orderBy("month")
    )


def product_trend(t: Tables, last_month: str | None = None) -> DataFrame:
    """First against last month per product. ``last_month`` ends the series before the data does."""
    totals = timeseries.period_totals(t.monthly_revenue, "product_name", "month")
    return (
        timeseries.first_last_trend(timeseries.up_to_period(totals, last_month))
        .select(
            "product_name",
            _money("first_total", "first_month_revenue"),
            _money("last_total", "last_month_revenue"),
            as_number(F.col("growth_pct")).alias("total_growth_pct"),
            "trend",
        )
        .orderBy(F.desc_nulls_first("total_growth_pct"), "product_name")
    )


def region_share(t: Tables) -> DataFrame:
    totals = t.monthly_revenue.groupBy("region").agg(
        F.sum("revenue").alias("total"), F.countDistinct("customer_id").alias("unique_customers")
    )
    per_customer = ratio(F.col("total"), count_as_decimal(F.col("unique_customers")), 2)
    return (
        shares.share_of_total(totals, "total", "share")
        .select(
            "region",
            _money("total", "total_revenue"),
            as_number(F.col("share")).alias("revenue_share_pct"),
            "unique_customers",
            as_number(per_customer).alias("revenue_per_customer"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "region")
    )


def churn_by_month(t: Tables) -> DataFrame:
    means = ("avg_credit_score", "avg_income", "avg_months_as_customer")
    return (
        customers.churn_profile(t.customers)
        .select("churn_month", "churned_customers", *[as_number(F.col(m)).alias(m) for m in means])
        .orderBy("churn_month")
    )


def cohort_retention(t: Tables) -> DataFrame:
    members = t.customers.select(
        "customer_id", month_of(F.col("join_date")).alias("cohort_month")
    )
    owners = t.accounts.select("account_id", "customer_id").join(members, "customer_id")
    activity = (
        timeseries.account_months(t.transactions)
        .withColumnRenamed("month", "active_month")
        .join(owners, "account_id")
    )
    return (
        timeseries.retention(members, activity)
        .select(
            "cohort_month",
            "cohort_size",
            "active_month",
            F.col("active_members").alias("active_customers"),
            as_number(F.col("retention_pct")).alias("retention_rate_pct"),
        )
        .orderBy("cohort_month", "active_month")
    )


def rfm_ntile(t: Tables, as_of: Column | None = None, best_is_high: bool = False) -> DataFrame:
    staying = t.customers.filter(~F.col("is_churned")).select("customer_id", _name(), "region")
    base, last_day = segmentation.rfm_ntile_base(t.transactions, t.accounts)
    as_of = F.date_add(last_day, 1) if as_of is None else as_of
    return (
        segmentation.rfm_ntile(base.join(staying, "customer_id"), as_of, best_is_high)
        .select(
            "customer_id",
            "customer_name",
            "region",
            F.col("recency_days").cast("bigint").alias("recency_days"),
            "frequency",
            _money("monetary"),
            "r_score",
            "f_score",
            "m_score",
            "rfm_total",
            "rfm_segment",
        )
        .orderBy(F.desc("rfm_total"), "customer_id")
    )


def cross_sell(t: Tables, most_products: int = 1, top: int = 100) -> DataFrame:
    active = t.accounts.filter(F.col("status") == "active")
    candidates = t.customers.filter(~F.col("is_churned")).select(
        "customer_id", _name(), "region", "credit_score", "annual_income"
    )
    return (
        customers.held_products(active, most_products)
        .join(candidates, "customer_id")
        .orderBy(F.desc_nulls_first("credit_score"), "customer_id")
        .limit(top)
        .select(
            "customer_id",
            "customer_name",
            "region",
            F.col("credit_score").cast("bigint").alias("credit_score"),
            "product_count",
            "products_held",
            F.col("annual_income").cast("bigint").alias("annual_income"),
        )
    )


def anomalies(t: Tables, threshold: float = 3.0, top: int = 50) -> DataFrame:
    """Completed transactions far above the mean of the completed non-fee ones."""
    completed = t.transactions.filter(F.col("status") == "completed")
    outliers = anomaly.zscore_outliers(
        completed, "amount", F.col("transaction_type") != "fee", threshold
    )
    order = (
        F.desc("z_score"),
        F.desc("amount"),
        "transaction_id",
        "account_id",
        "transaction_date",
        "transaction_type",
        "currency",
        F.asc_nulls_last("merchant_category"),
    )
    owners = t.accounts.select("account_id", "customer_id").join(
        t.customers.select("customer_id", _name()), "customer_id"
    )
    # only outliers of known owners count; the names are fetched for the rows of the report alone
    first = (
        outliers.withColumn("z_score", F.round("z_score", 2))
        .join(owners, "account_id", "left_semi")
        .orderBy(*order)
        .limit(top)
    )
    return (
        first.join(owners, "account_id")
        .select(
            "transaction_id",
            "account_id",
            "customer_name",
            "transaction_date",
            "transaction_type",
            as_number(F.col("amount")).alias("amount"),
            "currency",
            "merchant_category",
            "z_score",
        )
        .orderBy(*order)
    )


def quality_audit(t: Tables) -> DataFrame:
    return quality.quality_audit(t.customers, t.transactions)


def top_lifetime_value(t: Tables, top: int = 10) -> DataFrame:
    candidates = t.customers.filter(~F.col("is_churned")).select(
        "customer_id", _name(), "region", "join_date", "credit_score"
    )
    return (
        customers.lifetime_value(t.monthly_revenue)
        .join(candidates, "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "region",
            "join_date",
            _money("lifetime_revenue"),
            "products_held",
            F.col("credit_score").cast("bigint").alias("credit_score"),
        )
        .orderBy(F.desc_nulls_first("lifetime_revenue"), "customer_id")
        .limit(top)
    )


def quarter_four_by_region(t: Tables, year: int) -> DataFrame:
    q4 = is_quarter_four(F.col("month"))
    return (
        t.monthly_revenue.filter(F.col("month").startswith(f"{year:04d}"))
        .groupBy("region")
        .agg(
            _money(shares.sum_where(q4, F.col("revenue")), "q4_revenue"),
            _money(shares.sum_where(~q4, F.col("revenue")), "non_q4_revenue"),
            _money(F.sum("revenue"), "total_revenue"),
        )
        .orderBy(F.desc_nulls_first("q4_revenue"), "region")
    )


def monthly_active_users(t: Tables) -> DataFrame:
    activity = timeseries.account_months(t.transactions).join(
        t.accounts.select("account_id", "customer_id"), "account_id"
    )
    return timeseries.active_by_period(activity).withColumnRenamed("active", "mau").orderBy("month")


def transaction_values(t: Tables) -> DataFrame:
    """Count, mean, exact median and maximum by product and type."""
    completed = t.transactions.filter(F.col("status") == "completed")
    profile = anomaly.value_profile(
        completed, ["product_name", "transaction_type"], "amount", t.accounts, "account_id"
    )
    return profile.select(
        "product_name",
        "transaction_type",
        F.col("rows").alias("txn_count"),
        _money("mean", "avg_amount"),
        _money("median", "median_amount"),
        _money("maximum", "max_amount"),
    ).orderBy("product_name", F.desc("avg_amount"), "transaction_type")


def churn_inactivity(t: Tables, as_of: Column | None = None, top: int = 100) -> DataFrame:
    last_seen, last_day = customers.inactivity(t.transactions, t.accounts)
    as_of = F.date_add(last_day, 1) if as_of is None else as_of
    days = F.datediff(as_of, F.col("last_txn_date")).cast("bigint")
    quiet = (
        last_seen
        .withColumn("days_inactive", days)
        .filter(F.col("days_inactive") > 30)
    )
    label = customers.inactivity_label(F.col("days_inactive"), F.col("total_txns"))
    staying = t.customers.filter(~F.col("is_churned")).select(
        "customer_id", _name(), "region", "credit_score"
    )
    return (
        quiet.join(staying, "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "region",
            F.col("credit_score").cast("bigint").alias("credit_score"),
            "last_txn_date",
            "days_inactive",
            "total_txns",
            label.alias("churn_risk_label"),
        )
        .orderBy(F.desc("days_inactive"), "customer_id")
        .limit(top)
    )


def running_share(t: Tables) -> DataFrame:
    totals = timeseries.period_totals(t.monthly_revenue, "month")
    return (
        timeseries.running_share(totals)
        .select(
            "month",
            _money("total", "monthly_revenue"),
            _money("cumulative", "cumulative_revenue"),
            as_number(F.col("cumulative_pct")).alias("cumulative_pct"),
        )
        .orderBy("month")
    )


def revenue_next_month(t: Tables) -> DataFrame:
    """Each month with the following one."""
    totals = timeseries.period_totals(t.monthly_revenue, "month")
    return (
        timeseries.period_change(totals, direction="next")
        .select(
            "month",
            _money("total", "total_revenue"),
            _money("total_next", "next_revenue"),
            _money("change", "next_change"),
            as_number(F.col("change_pct")).alias("next_pct_change"),
        )
        .orderBy("month")
    )


def revenue_by(t: Tables, *keys: str, ascending_by_value: bool = False) -> DataFrame:
    """Chart data: summed revenue by month, region, or month and product."""
    totals = t.monthly_revenue.groupBy(*keys).agg(_money(F.sum("revenue"), "revenue"))
    order = ["revenue", *keys] if ascending_by_value else list(keys)
    return totals.orderBy(*[F.asc_nulls_last(c) for c in order])


def product_catalogue(t: Tables) -> DataFrame:
    return t.monthly_revenue.select("product_name").distinct().orderBy("product_name")


def single_product_share(t: Tables) -> DataFrame:
    """Share of active customers with one active product."""
    holders = (
        t.accounts.filter(F.col("status") == "active")
        .groupBy("customer_id")
        .agg(F.count("account_id").alias("products"))
        .join(t.customers.filter(~F.col("is_churned")).select("customer_id"), "customer_id")
    )
    single = F.count_if(F.col("products") == 1)
    everyone = F.count(F.lit(1))
    return holders.agg(
        everyone.alias("active_customers"),
        single.alias("single_product_customers"),
        as_number(percent(count_as_decimal(single), count_as_decimal(everyone), 1)).alias(
            "single_product_pct"
        ),
    )


def churn_rate_window(t: Tables, first_day: str, last_day: str) -> DataFrame:
    """Churn among customers present in a window of days, and churn outside the window.

    Present: joined by its last day and not gone before its first. The other rate is the churn at any
    other or unknown date among all customers.
    """
    first, last = F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))
    gone = F.coalesce(F.col("is_churned"), F.lit(False))
    inside = gone & F.coalesce(F.col("churn_date").between(first, last), F.lit(False))
    gone_before = gone & F.coalesce(F.col("churn_date") < first, F.lit(False))
    present = (F.col("join_date") <= last) & ~gone_before
    counted = t.customers.agg(
        F.count_if(present).alias("eligible_customers"),
        F.count_if(inside & present).alias("churned_in_window"),
        F.count(F.lit(1)).alias("all_customers"),
        F.count_if(gone & ~inside).alias("churned_elsewhere"),
    )
    def rate(part: str, whole: str) -> Column:
        return as_number(
            percent(count_as_decimal(F.col(part)), count_as_decimal(F.col(whole)), 1)
        )

    return counted.withColumns(
        {
            "window_churn_pct": rate("churned_in_window", "eligible_customers"),
            "other_churn_pct": rate("churned_elsewhere", "all_customers"),
        }
    )


def region_q4_per_customer(t: Tables, year: int) -> DataFrame:
    """Fourth-quarter revenue per customer with revenue in it, by region."""
    q4 = t.monthly_revenue.filter(
        F.col("month").startswith(f"{year:04d}") & is_quarter_four(F.col("month"))
    )
    totals = q4.groupBy("region").agg(
        F.sum("revenue").alias("total"), F.countDistinct("customer_id").alias("q4_customers")
    )
    per_customer = ratio(F.col("total"), count_as_decimal(F.col("q4_customers")), 2)
    return totals.select(
        "region",
        _money("total", "q4_revenue"),
        "q4_customers",
        as_number(per_customer).alias("q4_revenue_per_customer"),
    ).orderBy(F.desc_nulls_first("q4_revenue_per_customer"), "region")


def product_mix_growth(t: Tables, last_month: str | None = None) -> DataFrame:
    """Growth from the first to the last month, in total and by product.

    The fact is reduced once to product and month; the total row is summed from those. ``last_month``
    ends the series before the data does.
    """
    totals = timeseries.period_totals(t.monthly_revenue, "product_name", "month")
    lines = timeseries.up_to_period(totals, last_month).select(
        F.explode(F.array(F.col("product_name"), F.lit("All products"))).alias("product_name"),
        "month",
        "total",
    )
    return (
        timeseries.first_last_trend(timeseries.period_totals(lines, "product_name", "month", value="total"))
        .select(
            "product_name",
            _money("first_total", "first_revenue"),
            _money("last_total", "last_revenue"),
            as_number(F.col("growth_pct")).alias("growth_pct"),
        )
        .orderBy("product_name")
    )
