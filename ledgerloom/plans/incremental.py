"""Queries on state that batches are folded into, bound to the test tables, and the join that splits hot keys.

Each builds its state in a scratch folder from the given tables, in batches that come out of order, twice or broken, and
returns what a single pass over all rows would.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import as_number, month_of
from ledgerloom.operators import timeseries
from ledgerloom.operators.cleaning import TRANSACTION_ORDER
from ledgerloom.operators.hot_keys import split_join
from ledgerloom.operators.prefix_sums import open_by_day, running_sum
from ledgerloom.session import durable
from ledgerloom.sources import star, storage
from ledgerloom.sources.interleaved import read_interleaved, write_interleaved
from ledgerloom.sources.schemas import TRANSACTIONS
from ledgerloom.state import loads
from ledgerloom.state.batches import new_path
from ledgerloom.state.distinct_counts import DistinctCounts, estimates, sketch_bound, sketches
from ledgerloom.state.first_copies import FirstCopies
from ledgerloom.state.partial_sums import PartialSums
from ledgerloom.state.quantile_sketches import quantiles, rank_bound, summaries

#: days by which a copy of a transaction is later or earlier
COPY_DAYS = 30
#: spans of months whose baselines are asked for
SPANS = (("1992-01", "1993-06"), ("1993-07", "1997-12"), ("1996-03", "1996-03"), ("1992-01", "2001-12"))
QUANTILES = (0.1, 0.5, 0.9, 0.99)
#: filters on the columns of the interleaved table, ends included
LOOKUPS = {
    "day": {"transaction_date": (datetime.date(1996, 5, 1), datetime.date(1996, 6, 30))},
    "account": {"account_id": ("ACC12", "ACC13")},
    "region": {"region": ("ASIA", "ASIA")},
    "all": {
        "transaction_date": (datetime.date(1995, 1, 1), datetime.date(1996, 12, 31)),
        "account_id": ("ACC1", "ACC3"),
        "region": ("EUROPE", "EUROPE"),
    },
    "none": {"region": ("NOWHERE", "NOWHERE")},
}


def transactions_with_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with its product, customer and region: a join of rows, split at hot accounts."""
    t = star.StarTables(spark, sf_dir)
    owners = t.accounts.select("account_id", "customer_id", "product_name").join(t.customers.select("customer_id", "region"), "customer_id")
    moved = t.transactions.select("transaction_id", "account_id", "transaction_date", as_number(F.col("amount")).alias("amount"))
    joined = split_join(moved, owners, ["account_id"], "left", spread=["transaction_id"])
    return joined.select("transaction_id", "account_id", "customer_id", "product_name", "region", "transaction_date", "amount")


def _year_batches(day: Column) -> dict[str, Column]:
    """Which rows each batch holds, in the order in which they come."""
    return {"later": F.year(day) >= 1998, "early": F.year(day) < 1994, "middle": F.year(day).between(1994, 1997)}


def repeated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in three batches, one of them broken first, each loaded twice; customers in two that overlap."""
    t = star.StarTables(spark, sf_dir)
    with storage.scratch_folder(spark, "batches") as folder:
        for batch, chosen in _year_batches(F.col("transaction_date")).items():
            part = t.transactions.filter(chosen)
            if batch == "early":  # what a load leaves that broke before it was published
                storage.write_table(part, f"{folder}/transactions/{new_path()}", "transactions")
            for _ in range(2):
                loads.add_batch(spark, folder, batch, "transactions", part)
        age = F.col("age")
        for batch, chosen in {"young": age < 50, "old": age > 40, "young again": age < 50}.items():
            loads.add_batch(spark, folder, batch, "customers", t.customers.filter(chosen))
        stored = loads.read_loaded(spark, folder)
        moved = stored.transactions.groupBy(month_of(F.col("transaction_date")).alias("part")).agg(
            F.count(F.lit(1)).alias("rows"), as_number(F.sum("amount")).alias("amount")
        )
        people = stored.customers.groupBy(F.col("region").alias("part")).agg(
            F.count(F.lit(1)).alias("rows"), as_number(F.sum(F.col("annual_income").cast("decimal(12,2)"))).alias("amount")
        )
        return durable(
            moved.select(F.lit("transactions").alias("table_name"), "*").unionByName(people.select(F.lit("customers").alias("table_name"), "*"))
        )


def with_copies(transactions: DataFrame) -> DataFrame:
    """The transactions; of first items a later copy, of second ones an earlier copy, both failed."""
    item = F.substring_index("transaction_id", "-", -1)
    shift = F.when(item == "1", COPY_DAYS).when(item == "2", -COPY_DAYS)
    copies = transactions.withColumn("transaction_date", F.date_add("transaction_date", shift)).withColumn("status", F.lit("failed"))
    return transactions.unionByName(copies.filter(F.col("transaction_date").isNotNull()))


def first_copies_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copies of transactions that come in four batches by month, out of order, some of them again."""
    rows = with_copies(star.transactions(spark, sf_dir))
    quarter = F.month("transaction_date") % 4
    with storage.scratch_folder(spark, "first-copies") as folder:
        state = FirstCopies(spark, folder, TRANSACTIONS, ["transaction_id"], TRANSACTION_ORDER)
        for k, batch in ((2, "2"), (0, "0"), (2, "2"), (3, "3"), (0, "0 under another name"), (1, "1")):
            state.add(batch, rows.filter(quarter == k))
            if batch == "3":
                state.compact()
        return durable(state.current().withColumn("amount", as_number(F.col("amount"))))


def _activity(t: star.StarTables) -> DataFrame:
    """(month, region, customer_id) of all completed transactions."""
    owners = t.accounts.select("account_id", "customer_id").join(t.customers.select("customer_id", "region"), "customer_id")
    return timeseries.account_months(t.transactions).join(owners, "account_id").select("month", "region", "customer_id")


def distinct_customers_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers by month, quarter and year, by region and in all, from one stored state of bitmaps."""
    t = star.StarTables(spark, sf_dir)
    seen = durable(_activity(t))
    groups = {"month": T.StringType(), "region": T.StringType()}
    with storage.scratch_folder(spark, "distinct") as folder:
        state = DistinctCounts(spark, folder, "customer_id", T.StringType(), groups)
        for batch, chosen in {"late": F.col("month") >= "1995", "early": F.col("month") < "1996"}.items():
            state.add(batch, seen.filter(chosen))  # a year comes twice: its bitmaps are the same
        year, number = F.substring("month", 1, 4), F.substring("month", 6, 2).cast("int")
        periods = (F.col("month"), F.concat(year, F.lit("-Q"), F.ceil(number / 3).cast("string")), year)
        found = None
        for period in periods:
            for region in (F.col("region"), F.lit("All")):
                part = state.count(period.alias("period"), region.alias("region"), name="customers")
                found = part if found is None else found.unionByName(part)
        return durable(found)


def approximate_mau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers of months and years: exact, and whether the estimate from stored sketches is in its bound."""
    seen = durable(_activity(star.StarTables(spark, sf_dir)))
    with storage.scratch_folder(spark, "sketches") as folder:
        sketches(seen, "customer_id", ["month"]).write.parquet(folder)
        stored = spark.read.schema("month string, sketch binary").parquet(folder)
        parts = []
        for period in (F.col("month"), F.substring("month", 1, 4)):
            exact = seen.groupBy(period.alias("period")).agg(F.countDistinct("customer_id").alias("active"))
            guessed = estimates(stored, period.alias("period"), name="estimate")
            near = F.abs(F.col("estimate") - F.col("active")) <= sketch_bound() * F.col("active")
            parts.append(exact.join(guessed, "period").select("period", "active", near.alias("estimate_in_bound")))
        return durable(parts[0].unionByName(parts[1]))


def amount_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of completed amounts over several spans of months, from one stored state by month and account."""
    t = star.StarTables(spark, sf_dir)
    completed = t.transactions.filter(F.col("status") == "completed").withColumn("month", month_of(F.col("transaction_date")))
    groups = {"month": T.StringType(), "account_id": T.StringType()}
    with storage.scratch_folder(spark, "baselines") as folder:
        state = PartialSums(spark, folder, "amount", groups)
        for batch, chosen in _year_batches(F.col("transaction_date")).items():
            for _ in range(2):
                state.add(batch, completed.filter(chosen))
            if batch == "early":
                state.compact()
        found = None
        for first, last in SPANS:
            part = state.statistics(F.lit(f"{first} {last}").alias("span"), where=F.col("month").between(first, last))
            found = part if found is None else found.unionByName(part)
        rounded = {c: F.round(c, 4) for c in ("mean", "deviation")}
        return durable(found.withColumn("total", as_number(F.col("total"))).withColumns(rounded))


def running_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with the sum of all amounts of its currency up to it, by day, id and (of copies) amount."""
    rows = star.transactions(spark, sf_dir).select("transaction_id", "transaction_date", "currency", "amount")
    summed = running_sum(rows, "amount", ["transaction_date", "transaction_id", "amount"], "running_amount", ["currency"])
    return summed.withColumns({c: as_number(F.col(c)) for c in ("amount", "running_amount")})


def open_accounts_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open accounts by product at the end of each day on which one was opened or closed."""
    return open_by_day(star.accounts(spark, sf_dir), "open_date", "close_date", ["product_name"])


def approximate_amount_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By type and in all: rows, and whether quantiles read from monthly summaries have the rank that their bound states."""
    moved = durable(
        star.transactions(spark, sf_dir).select(month_of(F.col("transaction_date")).alias("month"), "transaction_type", "amount")
    )
    with storage.scratch_folder(spark, "summaries") as folder:
        summaries(moved, "amount", ["month", "transaction_type"]).write.parquet(folder)
        stored = spark.read.schema("month string, transaction_type string, summary binary").parquet(folder)
        parts = []
        for kind in (F.col("transaction_type"), F.lit("all")):
            found = quantiles(stored, QUANTILES, kind.alias("kind")).withColumnRenamed("value", "estimate").drop("n")
            # a few rows: the types and the shares asked for
            held = moved.select(kind.alias("kind"), F.col("amount").cast("double").alias("value")).join(F.broadcast(found), "kind")
            ranks = held.groupBy("kind", "share").agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("value") < F.col("estimate")).alias("below"),
                F.count_if(F.col("value") <= F.col("estimate")).alias("upto"),
            )
            share, n = F.col("share"), F.col("n")
            near = (F.col("below") <= (share + rank_bound()) * n) & (F.col("upto") >= (share - rank_bound()) * n)
            parts.append(ranks.select("kind", "share", "n", near.alias("rank_in_bound")))
        return durable(parts[0].unionByName(parts[1]))


def _located(t: star.StarTables) -> DataFrame:
    owners = t.accounts.select("account_id", "customer_id").join(t.customers.select("customer_id", "region"), "customer_id")
    moved = t.transactions.select("transaction_id", "account_id", "transaction_date", "amount")
    return moved.join(owners.select("account_id", "region"), "account_id").select("transaction_date", "account_id", "region", "amount")


def interleaved_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amount of filters on day, account and region alone and together, from one interleaved table."""
    located = durable(_located(star.StarTables(spark, sf_dir)))
    with storage.scratch_folder(spark, "interleaved") as folder:
        write_interleaved(located, folder, ["region", "transaction_date", "account_id"], 128)
        parts = []
        for name, ranges in LOOKUPS.items():
            rows = read_interleaved(spark, folder, located.schema, ranges)
            parts.append(
                rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(as_number(F.sum("amount")), F.lit(0.0)).alias("amount")).select(
                    F.lit(name).alias("filter"), "*"
                )
            )
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return durable(found)


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by region from transactions and accounts that are stored in the same buckets: joined without a shuffle."""
    t = star.StarTables(spark, sf_dir)
    database = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}`")
    try:
        moved, owners = f"`{database}`.moved", f"`{database}`.owners"
        storage.save_bucketed(t.transactions.select("account_id", "amount", "status"), moved, "account_id", 16)
        regions = t.accounts.select("account_id", "customer_id").join(t.customers.select("customer_id", "region"), "customer_id")
        storage.save_bucketed(regions, owners, "account_id", 16)
        joined = spark.table(moved).hint("merge").join(spark.table(owners), "account_id")
        return durable(
            joined.groupBy("region", "status").agg(F.count(F.lit(1)).alias("transactions"), as_number(F.sum("amount")).alias("amount"))
        )
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        transactions_with_owner,
        repeated_batches,
        first_copies_over_batches,
        distinct_customers_by_period,
        approximate_mau,
        amount_baselines,
        running_amounts,
        open_accounts_by_day,
        approximate_amount_quantiles,
        interleaved_lookups,
        bucketed_join,
    )
    return {query.__name__: query for query in listed}
