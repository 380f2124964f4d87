"""Every query by name, bound to the star-schema parquet tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import as_number, half_even, month_index, padded_id, tenure_months
from ledgerloom.operators import anomaly, customers, quality, segmentation, shares, timeseries
from ledgerloom.operators.cleaning import (
    TRANSACTION_ORDER,
    clean_transactions,
    cleaning_profile,
    dedupe_keep_first,
    fill_missing,
    normalise_currency,
)
from ledgerloom.operators.order_statistics import global_ntile, rank_quantile_buckets
from ledgerloom.operators.quantiles import quantile_bucket
from ledgerloom.plans import incremental, reports, scoring
from ledgerloom.session import durable
from ledgerloom.sources import star, storage
from ledgerloom.sources.schemas import CUSTOMERS, MONTHLY_REVENUE, Tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the bound queries.
REPORT_YEAR = 2000
WINDOW = ("2000-04-01", "2000-05-31")
STORED_MONTHS = ("1998-03", "1999-02")
BATCH_MONTH = "1998-01"


def _on_tables(report: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(star.StarTables(spark, sf_dir))


def _transaction_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", as_number(F.col("amount")))


def _rfm_rows(rfm: DataFrame) -> DataFrame:
    return rfm.withColumns(
        {"recency": F.col("recency").cast("bigint"), "monetary": as_number(F.col("monetary"))}
    )


def _rfm_base(t: Tables) -> DataFrame:
    return _rfm_rows(scoring.rfm_base(t))


def _rfm_segments(t: Tables) -> DataFrame:
    return _rfm_rows(scoring.rfm_segments(t))


def _churn_rows(risk: DataFrame) -> DataFrame:
    return _rfm_rows(risk).withColumn("risk_score", F.col("risk_score").cast("bigint"))


def _kpi_rows(kpi: DataFrame) -> DataFrame:
    decimals = ("avg_monetary", "avg_recency_days", "total_revenue")
    return kpi.withColumns({name: as_number(F.col(name)) for name in decimals})


def _recency_buckets(t: Tables) -> DataFrame:
    base = scoring.rfm_base(t)
    scored = quantile_bucket(base, "recency", 5, [5, 4, 3, 2, 1], "r_score")
    return scored.select("customer_id", F.col("recency").cast("bigint").alias("recency"), "r_score")


def _rank_scores(t: Tables) -> DataFrame:
    measures = {"f_score": F.col("frequency"), "m_score": F.col("monetary")}
    scored = rank_quantile_buckets(scoring.rfm_base(t), 5, measures, "customer_id")
    return scored.select("customer_id", "frequency", "f_score", "m_score")


def _balance_quintiles(t: Tables) -> DataFrame:
    held = t.accounts.select("account_id", "balance")
    tiled = global_ntile(held, 5, {"quintile": -F.col("balance")}, "account_id")
    return tiled.withColumn("balance", as_number(F.col("balance")))


def _active_accounts(t: Tables) -> DataFrame:
    end = t.transactions.agg(F.max("transaction_date")).scalar()
    return timeseries.active_accounts_by_month(t.accounts, end).orderBy("month")


def _region_lookup(t: Tables) -> DataFrame:
    """Region of each account's owner if the owner is still a customer."""
    staying = t.customers.filter(~F.col("is_churned"))
    accounts = t.accounts.select("account_id", "customer_id")
    found = shares.lookup_with_default(accounts, staying, "customer_id", "region", "No region")
    return found.select("account_id", "customer_id", "region")


def _tenure(t: Tables) -> DataFrame:
    until = F.coalesce(F.col("churn_date"), customers.next_day(t.transactions))
    months = tenure_months(F.col("join_date"), until)
    return t.customers.select("customer_id", months.cast("bigint").alias("tenure_months"))


def _month_numbers(t: Tables) -> DataFrame:
    number = month_index(F.col("transaction_date"), 1995).cast("bigint").alias("month_number")
    return t.transactions.groupBy(number).agg(F.count(F.lit(1)).alias("transactions"))


def _padded_ids(t: Tables) -> DataFrame:
    number = F.col("last_name").cast("bigint")
    return t.customers.select("customer_id", padded_id("CUST", number, 5).alias("short_id"))


def _table_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four tables declared in a catalog, then their comments with the rows of the data bound to them."""
    database = f"declared_{uuid.uuid4().hex}"
    try:
        storage.create_tables(spark, database)
        comments = storage.table_comments(spark, database)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    said = F.create_map(*[F.lit(part) for pair in comments.items() for part in pair])
    counts = quality.table_row_counts(star.StarTables(spark, sf_dir).named())
    return counts.withColumn("table_comment", said[F.col("table_name")])


def _half_even_profile(t: Tables) -> DataFrame:
    """A quarter of each balance, rounded to cents with ties to the even one, summed by product."""
    quarter = F.col("balance").cast("decimal(18,4)") * F.lit(Decimal("0.25"))
    return t.accounts.groupBy("product_name").agg(
        as_number(F.sum(half_even(quarter, 2))).alias("quarter_balances")
    )


def _event_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.star_table(spark, sf_dir, "events")
    return anomaly.zscore_outliers(events, "value").withColumn("z_score", F.round("z_score", 4))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV and read back with declared types."""
    with storage.scratch_folder(spark, "customers-csv") as folder:
        storage.write_csv(star.customers(spark, sf_dir), folder)
        back = storage.read_csv_table(spark, folder, CUSTOMERS)
        return durable(
            back.withColumns(
                {c: F.col(c).cast("bigint") for c in ("age", "credit_score", "annual_income")}
            )
        )


def _ingested_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables through CSV files into parquet, dimensions first, then counted."""
    with storage.scratch_folder(spark, "raw") as raw, storage.scratch_folder(spark, "stored") as stored:
        for name, df in star.StarTables(spark, sf_dir).named().items():
            storage.write_csv(df, f"{raw}/{name}.csv")
        counts, _ = storage.ingest_csv(spark, raw, stored)
        return durable(counts)


def _stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions stored by month, then a span of months read back."""
    with storage.scratch_folder(spark, "transactions") as folder:
        storage.write_table(star.transactions(spark, sf_dir), folder, "transactions")
        return durable(_transaction_rows(storage.transactions_between(spark, folder, *STORED_MONTHS)))


def _appended_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue recreated with the earlier months, then the later ones appended."""
    with storage.scratch_folder(spark, "monthly-revenue") as folder:
        revenue = star.monthly_revenue(spark, sf_dir)
        early = F.col("month") < BATCH_MONTH
        storage.write_table(revenue.filter(early), folder, "monthly_revenue", "overwrite")
        storage.write_table(revenue.filter(~early), folder, "monthly_revenue", "append")
        stored = storage.read_table(spark, folder, "monthly_revenue")
        return durable(
            stored.groupBy("month").agg(
                F.count(F.lit(1)).alias("rows"), as_number(F.sum("revenue")).alias("revenue")
            )
        )


def _exported_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four exports written; the churn export read back."""
    with storage.scratch_folder(spark, "exports") as folder:
        exports = scoring.run_exports(star.StarTables(spark, sf_dir), folder)
        back = storage.read_csv_table(spark, f"{folder}/churn_risk", exports.churn_risk.schema)
        return durable(_churn_rows(back))


def _exported_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole monthly table exported as CSV and read back."""
    with storage.scratch_folder(spark, "exports") as folder:
        revenue = star.monthly_revenue(spark, sf_dir)
        storage.export_reports({"monthly_revenue": revenue}, folder)
        back = storage.read_csv_table(spark, f"{folder}/monthly_revenue", MONTHLY_REVENUE)
        return durable(
            back.withColumns({c: as_number(F.col(c)) for c in ("revenue", "fee_charged")})
        )


def queries() -> dict[str, Query]:
    on = _on_tables
    return {
        # the fifteen reports
        "q01_revenue_mom": on(reports.revenue_mom),
        "q02_product_trend": on(reports.product_trend),
        "q03_region_share": on(reports.region_share),
        "q04_churn_by_month": on(reports.churn_by_month),
        "q05_cohort_retention": on(reports.cohort_retention),
        "q06_rfm_ntile": on(reports.rfm_ntile),
        "q07_cross_sell": on(reports.cross_sell),
        "q08_anomalies": on(reports.anomalies),
        "q09_quality_audit": on(reports.quality_audit),
        "q10_top_ltv": on(reports.top_lifetime_value),
        "q11_q4_by_region": on(lambda t: reports.quarter_four_by_region(t, REPORT_YEAR)),
        "q12_mau": on(reports.monthly_active_users),
        "q13_txn_value": on(reports.transaction_values),
        "q14_churn_inactivity": on(reports.churn_inactivity),
        "q15_running_share": on(reports.running_share),
        # table checks, sources and sinks
        "table_row_counts": on(lambda t: quality.table_row_counts(t.named())),
        "integrity_audit": on(lambda t: quality.integrity_audit(t.named())),
        "csv_round_trip": _csv_round_trip,
        "ingested_row_counts": _ingested_counts,
        "stored_month_range": _stored_months,
        "appended_batches": _appended_batches,
        "exported_churn_risk": _exported_churn_risk,
        "exported_monthly_revenue": _exported_monthly_revenue,
        # cleaning
        "dedupe_transactions": on(
            lambda t: _transaction_rows(
                dedupe_keep_first(t.transactions, ["transaction_id"], TRANSACTION_ORDER)
            )
        ),
        "normalise_currency": on(lambda t: _transaction_rows(normalise_currency(t.transactions))),
        "fill_missing": on(lambda t: _transaction_rows(fill_missing(t.transactions))),
        "clean_transactions": on(lambda t: _transaction_rows(clean_transactions(t.transactions))),
        "cleaning_profile": on(lambda t: cleaning_profile(t.transactions)),
        # ranks, buckets and segmentation
        "ntile_quintiles": on(_balance_quintiles),
        "quantile_cut_recency": on(_recency_buckets),
        "rank_quintile_scores": on(_rank_scores),
        "rfm_base": on(_rfm_base),
        "rfm_segments": on(_rfm_segments),
        "rfm_segment_counts": on(lambda t: scoring.segment_counts(scoring.rfm_segments(t))),
        "rfm_ntile_best_high": on(lambda t: reports.rfm_ntile(t, best_is_high=True)),
        "churn_risk_scores": on(lambda t: _churn_rows(scoring.churn_risk(scoring.rfm_segments(t)))),
        "churn_label_counts": on(lambda t: scoring.risk_counts(scoring.rfm_segments(t))),
        "kpi_summary": on(
            lambda t: _kpi_rows(
                segmentation.kpi_summary(scoring.rfm_segments(t), t.monthly_revenue)
            )
        ),
        "segment_revenue_share": on(
            lambda t: scoring.segment_revenue_share(scoring.rfm_segments(t), t.monthly_revenue)
        ),
        # series, chart data and headline shares
        "revenue_next_month": on(reports.revenue_next_month),
        "monthly_revenue_trend": on(lambda t: reports.revenue_by(t, "month")),
        "revenue_by_region": on(lambda t: reports.revenue_by(t, "region", ascending_by_value=True)),
        "product_revenue_trend": on(lambda t: reports.revenue_by(t, "month", "product_name")),
        "product_catalogue": on(reports.product_catalogue),
        "active_accounts_by_month": on(_active_accounts),
        "single_product_share": on(reports.single_product_share),
        "churn_rate_window": on(lambda t: reports.churn_rate_window(t, *WINDOW)),
        "region_q4_per_customer": on(lambda t: reports.region_q4_per_customer(t, REPORT_YEAR)),
        "product_mix_growth": on(reports.product_mix_growth),
        # lookups, calendar and id functions, second outlier binding
        "lookup_with_default": on(_region_lookup),
        "tenure_months": on(_tenure),
        "month_index": on(_month_numbers),
        "padded_ids": on(_padded_ids),
        "event_value_outliers": _event_outliers,
        "table_comments": _table_comments,
        "half_even_balances": on(_half_even_profile),
        # batches and stored state
        **incremental.queries(),
    }
