"""Row counts, integrity checks and the quality audit, as reports instead of constraints."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TEXT_LENGTHS, UNIQUE_COLUMNS


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def as_rows(df: DataFrame, counters: Mapping[tuple[str, ...], Column], names: tuple[str, ...]) -> DataFrame:
    """Several aggregates in one pass, turned into one labelled row each.

    ``counters`` maps the label values of a row to its aggregate; ``names`` are the label columns and
    the value column.
    """
    aggregates = [c.cast("bigint").alias(f"_{i}") for i, c in enumerate(counters.values())]
    rows = [
        F.struct(
            *[F.lit(text).alias(name) for text, name in zip(labels, names)],
            F.col(f"_{i}").alias(names[-1]),
        )
        for i, labels in enumerate(counters)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


_CHECK = ("table_name", "check_name", "column_name", "violations")


def integrity_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key, uniqueness, reference and length rule with the number of violations.

    Repeated keys count the values that occur more than once; the other checks count rows. NULL is no reference and no
    repeated value. Every table is read once: a row gives its own keys and the keys it refers to, each tagged with the
    column whose values it is one of, and its missing and over-long values. All of them are counted by column and
    value in one shuffle; a value with very many rows is one row a task before that.
    """
    mentions = []
    counters: dict[tuple[str, ...], Column] = {}
    domain, value, role = F.col("domain"), F.col("value"), F.col("role")

    def tagged(where: Column, of: str, key: Column, as_: str) -> Column:
        return F.when(where, F.struct(F.lit(of).alias("domain"), key.alias("value"), F.lit(as_).alias("role")))

    for table, df in tables.items():
        said = []
        key = PRIMARY_KEYS.get(table)
        flags = {("missing key", key): F.col(key).isNull()} if key else {}
        flags |= {(f"longer than {longest}", c): F.length(c) > longest for c, longest in TEXT_LENGTHS[table].items()}
        for (check, column), wrong in flags.items():
            counters[(table, check, column)] = F.sum(F.when(domain == f"{table} {check} {column}", F.col("wrong")))
            said.append(tagged(F.coalesce(wrong, F.lit(False)), f"{table} {check} {column}", F.lit(""), "wrong"))
        for column in ([key] if key else []) + list(UNIQUE_COLUMNS.get(table, ())):
            repeated = (domain == f"{table}.{column}") & (F.col("own") > 1)
            counters[(table, "repeated value", column)] = F.count_if(repeated)
            said.append(tagged(F.col(column).isNotNull(), f"{table}.{column}", F.col(column), "own"))
        for child, column, parent in FOREIGN_KEYS:
            if child == table:
                said.append(tagged(F.col(column).isNotNull(), f"{parent}.{PRIMARY_KEYS[parent]}", F.col(column), f"{child} {column}"))
        mentions.append(df.select(F.inline(F.array_compact(F.array(*said)))))
    for child, column, parent in FOREIGN_KEYS:
        lost = (domain == f"{parent}.{PRIMARY_KEYS[parent]}") & (F.col("own") == 0)
        counters[(child, f"not in {parent}", column)] = F.sum(F.when(lost, F.col(f"{child} {column}")))
    roles = ["own", "wrong", *[f"{child} {column}" for child, column, _ in FOREIGN_KEYS]]
    per_value = _union(mentions).groupBy(domain, value).agg(*[F.count_if(role == name).alias(name) for name in roles])
    return as_rows(per_value, {labels: F.coalesce(c, F.lit(0)) for labels, c in counters.items()}, _CHECK)


def quality_audit(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Five known issues and the rows they touch: one pass per table."""
    in_transactions = {
        ("transactions", "null description"): F.count_if(F.col("description").isNull()),
        ("transactions", "duplicate transaction_id"): F.count(F.lit(1))
        - F.countDistinct("transaction_id"),
        ("transactions", "USD currency (needs conversion)"): F.count_if(F.col("currency") == "USD"),
        ("transactions", "failed status"): F.count_if(F.col("status") == "failed"),
    }
    undated = F.col("is_churned") & F.col("churn_date").isNull()
    in_customers = {("customers", "churned without churn_date"): F.count_if(undated)}
    names = ("table_name", "issue", "affected_rows")
    return as_rows(transactions, in_transactions, names).unionByName(
        as_rows(customers, in_customers, names)
    )
