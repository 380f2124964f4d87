"""Readers, writers and table layout."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.quality import integrity_audit, table_row_counts
from ledgerloom.session import durable, shared_dir
from ledgerloom.sources.schemas import COMMENTS, SCHEMAS, Tables

# The month column that partitions each fact; dimensions have none.
MONTH_COLUMNS = {"transactions": "transaction_month", "monthly_revenue": "month"}
SORT_COLUMNS = {
    "customers": ("customer_id",),
    "accounts": ("customer_id", "account_id"),
    "transactions": ("account_id", "transaction_date"),
    "monthly_revenue": ("account_id",),
}


# Both directions: a quote inside a text is doubled, nothing else is escaped, spaces are text.
CSV_OPTIONS = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
    "lineSep": "\n",
}


#: The facts are large and have no line breaks in their texts, so their files are split over tasks. (One that has them fails
#: the read; ``multi_line=True`` reads it, by one task a file.)
MULTI_LINE = {"customers": True, "accounts": True, "transactions": False, "monthly_revenue": False}


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV with a header and declared types: no inference pass, and a bad value fails the read.

    Empty fields are NULL, empty quoted ones are empty text. With ``multi_line`` texts may hold line
    breaks, and a file is read by one task; turn it off for files that have none, so that large ones
    are split.
    """
    # the reader puts ``nullValue`` in empty fields; a sign that no text holds tells them from empty texts
    options = {**CSV_OPTIONS, "nullValue": "\0", "emptyValue": "", "multiLine": str(multi_line).lower()}
    options.pop("lineSep")  # files of other writers may end lines with \r\n
    return (
        spark.read.schema(schema)
        .options(**options)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv_tables(spark: SparkSession, folder: str, multi_line: bool | None = None) -> Tables:
    """The four ``<folder>/<table>.csv`` files or folders; ``multi_line`` by table if it isn't given."""
    return Tables(
        **{
            name: read_csv_table(
                spark, f"{folder}/{name}.csv", schema, MULTI_LINE[name] if multi_line is None else multi_line
            )
            for name, schema in SCHEMAS.items()
        }
    )


def with_defaults(customers: DataFrame) -> DataFrame:
    """The column default of the customer table: a missing churn flag is false."""
    return customers.withColumn("is_churned", F.coalesce("is_churned", F.lit(False)))


def _laid_out(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """Rows clustered for writing.

    ``rebalance`` groups a month's rows in few files and splits a month that is too large for one
    task; sorting makes the min/max statistics of each file selective.
    """
    month = MONTH_COLUMNS.get(name)
    if name == "transactions":
        df = df.withColumn(month, F.date_format("transaction_date", "yyyy-MM"))
    by = [month] if month else []
    spread = df.hint("rebalance", *by) if by else df.hint("rebalance")
    return spread.sortWithinPartitions(*by, *SORT_COLUMNS[name]), by


def write_table(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    """``overwrite`` is drop and recreate, ``append`` adds a batch."""
    clustered, by = _laid_out(df, name)
    clustered.write.mode(mode).partitionBy(*by).parquet(path)


def write_tables(tables: Tables, folder: str, mode: str = "overwrite") -> None:
    """Dimensions first, then the facts that refer to them."""
    for name, df in tables.named().items():
        write_table(df, f"{folder}/{name}", name, mode)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored table. A filter on ``MONTH_COLUMNS[name]`` prunes whole folders."""
    schema = SCHEMAS[name]
    month = MONTH_COLUMNS.get(name)
    if month and month not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(month, T.StringType())])
    return spark.read.schema(schema).parquet(path)


def read_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        **{
            name: read_table(spark, f"{folder}/{name}", name).select(*schema.names)
            for name, schema in SCHEMAS.items()
        }
    )


def transactions_between(
    spark: SparkSession, path: str, first_month: str, last_month: str
) -> DataFrame:
    """Stored transactions of a span of months; only those folders are read."""
    stored = read_table(spark, path, "transactions")
    wanted = F.col("transaction_month").between(first_month, last_month)
    return stored.filter(wanted).select(*SCHEMAS["transactions"].names)


class IntegrityError(ValueError):
    """Staged tables that break the rules; ``violations`` lists (table, check, column, rows)."""

    def __init__(self, violations: list[tuple]):
        self.violations = violations
        super().__init__("; ".join(f"{t}.{c}: {check} ({n} rows)" for t, check, c, n in violations))


def ingest_csv(
    spark: SparkSession,
    raw_folder: str,
    folder: str,
    mode: str = "overwrite",
    strict: bool = False,
    multi_line: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """CSV to parquet, dimensions first. Returns the row counts and the integrity report.

    The files are staged in the shared folder and audited there, together with what is stored already
    if they are appended. Only then are the tables written; with ``strict`` a violated rule raises
    :class:`IntegrityError` and leaves them as they were. Files that come again are appended again;
    :func:`ledgerloom.state.loads.load_batch` takes each batch once.
    """
    raw = read_csv_tables(spark, raw_folder, multi_line).named()
    raw["customers"] = with_defaults(raw["customers"])
    with scratch_folder(spark, "staged") as staging:
        write_tables(Tables(**raw), staging)
        staged = read_tables(spark, staging)
        whole = staged.named()
        if mode == "append":
            for name, df in read_tables(spark, folder).named().items():
                whole[name] = df.unionByName(whole[name])
        audit = durable(integrity_audit(whole))
        if strict:
            broken = audit.filter(F.col("violations") > 0).collect()  # at most one row per rule
            if broken:
                raise IntegrityError([tuple(row) for row in broken])
        write_tables(staged, folder, mode)
    return table_row_counts(read_tables(spark, folder).named()), audit


def create_tables(spark: SparkSession, database: str) -> None:
    """Empty catalog tables with types, partitioning and comments; existing ones are dropped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in reversed(SCHEMAS):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    for name, schema in SCHEMAS.items():
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        month = MONTH_COLUMNS.get(name)
        if month and month not in schema.names:
            columns.append(f"`{month}` string")
        partitioned = f"PARTITIONED BY (`{month}`) " if month else ""
        spark.sql(
            f"CREATE TABLE `{database}`.`{name}` ({', '.join(columns)}) USING parquet "
            f"{partitioned}COMMENT '{COMMENTS[name]}'"
        )


def table_comments(spark: SparkSession, database: str) -> dict[str, str]:
    """Comment of each declared table, as the catalog has it."""
    return {name: spark.catalog.getTable(f"`{database}`.`{name}`").description for name in SCHEMAS}


def append_to_catalog(df: DataFrame, database: str, name: str) -> None:
    """Appends by column name; the month partition of transactions is derived."""
    clustered, _ = _laid_out(df, name)
    stored = df.sparkSession.table(f"`{database}`.`{name}`").columns
    clustered.select(*stored).write.mode("append").insertInto(f"`{database}`.`{name}`")


def read_catalog_tables(spark: SparkSession, database: str) -> Tables:
    return Tables(
        **{
            name: spark.table(f"`{database}`.`{name}`").select(*schema.names)
            for name, schema in SCHEMAS.items()
        }
    )


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Bucketed and sorted copy: tables bucketed alike join on ``key`` without a shuffle.

    A hot key fills one bucket; roll-ups that aggregate per key first do not need this layout.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def jdbc_read_options(
    url: str, table: str, column: str, lower: str, upper: str, partitions: int, **extra: str
) -> dict[str, str]:
    """A parallel scan: each task reads one range of ``column``."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        **extra,
    }


def read_jdbc_table(spark: SparkSession, **options: str) -> DataFrame:
    """Database scan; see :func:`jdbc_read_options`. Filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load()


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 1000, **options: str) -> None:
    """Appends in batches of ``batch_rows`` rows per statement."""
    settings = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **options}
    df.write.format("jdbc").options(**settings).mode("append").save()


def export_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """One CSV folder per report, written in parallel; one-row reports are one file by nature."""
    for name, df in reports.items():
        write_csv(df, f"{folder}/{name}")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A folder under the shared folder that is deleted at the end, also after an error."""
    folder = fresh_folder(spark, purpose)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)
