import csv
import datetime
import glob
import os
import re
from unittest import mock

import pytest
from pyspark.sql import functions as F

from helpers import accounts, customers, plan, revenue, transactions, values
from ledgerloom import session
from ledgerloom.operators.quality import table_row_counts
from ledgerloom.plans import catalog, scoring
from ledgerloom.sources import storage
from ledgerloom.sources.schemas import COMMENTS, CUSTOMERS, SCHEMAS, Tables


@pytest.fixture
def small(spark):
    return Tables(
        customers(spark, [("C1", "R", "2023-01-01", False, None), ("C2", None, "2023-02-01", True, "2023-03-01")]),
        accounts(spark, [("A1", "C1", "P"), ("A2", "C2", "Q", "closed", "2023-02-01", "2023-03-01")]),
        transactions(
            spark,
            [(f"T{i}", f"A{1 + i % 2}", f"2023-{1 + i % 4:02d}-10", "deposit", i, "CAD", None) for i in range(40)],
        ),
        revenue(spark, [(f"2023-{m:02d}", "A1", "C1", "P", "R", m) for m in range(1, 5)]),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_round_trip_keeps_types_and_nulls(spark, small, tmp_path):
    for name, df in small.named().items():
        storage.write_csv(df, f"{tmp_path}/{name}.csv")
    back = storage.read_csv_tables(spark, str(tmp_path))
    for name, df in small.named().items():
        assert back.named()[name].schema == SCHEMAS[name]
        assert rows(back.named()[name]) == rows(df)


AWKWARD = [
    'He said "hi", then left',
    "two\nlines",
    "carriage\r\nreturn",
    "ends in a backslash\\",
    'a \\" b',
    "",
    "  spaces around  ",
    None,
    '"',
    ",",
    "plain",
]
TEXTS = "id int, text string, tail string"


@pytest.mark.parametrize("partitions", [1, 3])
def test_awkward_texts_come_back_from_csv(spark, tmp_path, partitions):
    df = spark.createDataFrame([(k, text, "end") for k, text in enumerate(AWKWARD)], TEXTS).repartition(partitions)
    storage.write_csv(df, f"{tmp_path}/own")
    assert rows(storage.read_csv_table(spark, f"{tmp_path}/own", df.schema)) == rows(df)


def test_csv_of_pythons_writer_and_for_its_reader(spark, tmp_path):
    schema = spark.createDataFrame([], TEXTS).schema
    texts = [text for text in AWKWARD if text]  # other writers don't tell empty from missing
    with open(tmp_path / "other.csv", "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(schema.names)
        writer.writerows([k, text, "end"] for k, text in enumerate(texts))
    back = storage.read_csv_table(spark, f"{tmp_path}/other.csv", schema)
    # the reader takes every line end for a line feed
    assert rows(back) == sorted((k, text.replace("\r\n", "\n"), "end") for k, text in enumerate(texts))
    df = spark.createDataFrame([(k, text, "end") for k, text in enumerate(texts)], TEXTS).coalesce(1)
    storage.write_csv(df, f"{tmp_path}/own")
    (part,) = glob.glob(f"{tmp_path}/own/*.csv")
    with open(part, newline="") as file:
        assert list(csv.reader(file)) == [schema.names] + [[str(k), text, "end"] for k, text in enumerate(texts)]


def test_plain_csv_can_be_split(spark, small, tmp_path):
    storage.write_csv(small.transactions, f"{tmp_path}/t")
    back = storage.read_csv_table(spark, f"{tmp_path}/t", small.transactions.schema, multi_line=False)
    assert rows(back) == rows(small.transactions)


def test_csv_with_a_bad_value_or_header_fails(spark, tmp_path):
    header = ",".join(CUSTOMERS.names)
    bad = tmp_path / "bad.csv"
    bad.write_text(f"{header}\nC1,A,B,e,R,not a number,2023-01-01,false,,700,1\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        storage.read_csv_table(spark, str(bad), CUSTOMERS).collect()
    swapped = tmp_path / "swapped.csv"
    swapped.write_text(header.replace("first_name,last_name", "last_name,first_name") + "\n" + "a," * 10 + "a\n")
    with pytest.raises(Exception):
        storage.read_csv_table(spark, str(swapped), CUSTOMERS).collect()


def test_overwrite_replaces_and_append_adds(spark, small, tmp_path):
    folder = str(tmp_path)
    storage.write_tables(small, folder)
    storage.write_tables(small, folder)
    assert rows(storage.read_tables(spark, folder).transactions) == rows(small.transactions)
    storage.write_table(small.transactions, f"{folder}/transactions", "transactions", "append")
    assert storage.read_tables(spark, folder).transactions.count() == 80


def test_month_folders_are_pruned(spark, small, tmp_path):
    path = f"{tmp_path}/transactions"
    storage.write_table(small.transactions, path, "transactions")
    assert len(glob.glob(f"{path}/transaction_month=*")) == 4
    span = storage.transactions_between(spark, path, "2023-02", "2023-03")
    assert span.count() == 20
    assert "PartitionFilters: [isnotnull(transaction_month" in plan(span)
    assert span.filter(F.col("transaction_date") < datetime.date(2023, 2, 1)).count() == 0


def test_ingest_reports_counts_and_defaults_the_flag(spark, small, tmp_path):
    raw, stored = f"{tmp_path}/raw", f"{tmp_path}/stored"
    people = small.customers.withColumn("is_churned", F.lit(None).cast("boolean"))
    for name, df in {**small.named(), "customers": people}.items():
        storage.write_csv(df, f"{raw}/{name}.csv")
    counts, audit = storage.ingest_csv(spark, raw, stored)
    assert dict(values(counts, "table_name", "row_count")) == {
        "customers": 2, "accounts": 2, "transactions": 40, "monthly_revenue": 4,
    }
    assert audit.filter("violations > 0").count() == 0
    assert values(storage.read_tables(spark, stored).customers, "is_churned") == {(False,)}


def test_strict_ingest_leaves_the_stored_tables_alone(spark, small, tmp_path):
    raw, stored = f"{tmp_path}/raw", f"{tmp_path}/stored"
    for name, df in small.named().items():
        storage.write_csv(df, f"{raw}/{name}.csv")
    storage.ingest_csv(spark, raw, stored, strict=True)
    before = {name: rows(df) for name, df in storage.read_tables(spark, stored).named().items()}
    stray = accounts(spark, [("A1", "C1", "P"), ("A9", "nobody", "P")])
    storage.write_csv(stray, f"{raw}/accounts.csv")
    for mode in ("overwrite", "append"):
        with pytest.raises(storage.IntegrityError, match="accounts.customer_id") as broken:
            storage.ingest_csv(spark, raw, stored, mode, strict=True)
        assert broken.value.violations
        assert {n: rows(df) for n, df in storage.read_tables(spark, stored).named().items()} == before
    _, audit = storage.ingest_csv(spark, raw, stored)
    assert audit.filter("violations > 0").count() > 0
    assert storage.read_tables(spark, stored).accounts.count() == 2
    assert not glob.glob(f"{session.shared_dir(spark)}/staged-*")


@pytest.mark.parametrize(
    "name",
    ["csv_round_trip", "ingested_row_counts", "stored_month_range", "appended_batches", "exported_churn_risk", "exported_monthly_revenue"],
)
def test_queries_leave_no_folder(spark, name):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    left = lambda: {f for f in os.listdir(session.shared_dir(spark)) if not re.fullmatch(r"[0-9a-f-]{36}", f)}
    before = left()
    assert catalog.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert left() == before


def test_catalog_tables(spark, small):
    storage.create_tables(spark, "ledger_test")
    for name, df in small.named().items():
        storage.append_to_catalog(df, "ledger_test", name)
        described = spark.sql(f"DESCRIBE TABLE EXTENDED ledger_test.{name}").collect()
        assert COMMENTS[name] in {r["data_type"] for r in described}
    stored = storage.read_catalog_tables(spark, "ledger_test").named()
    assert rows(stored["transactions"]) == rows(small.transactions)
    assert dict(values(table_row_counts(stored), "table_name", "row_count"))["transactions"] == 40
    assert storage.table_comments(spark, "ledger_test") == COMMENTS
    storage.create_tables(spark, "ledger_test")
    assert spark.table("ledger_test.customers").count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, small, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_buckets")
    storage.save_bucketed(small.transactions, "ledger_buckets.t", "account_id", 4)
    storage.save_bucketed(small.accounts, "ledger_buckets.a", "account_id", 4)
    joined = spark.table("ledger_buckets.t").join(spark.table("ledger_buckets.a"), "account_id")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 40


def test_exports(spark, small, tmp_path):
    many = [(f"T{c}-{n}", f"A{c}", f"2023-01-{1 + (c * 3 + n) % 28:02d}", "deposit", c + n) for c in range(20) for n in range(1 + c % 4)]
    t = Tables(
        customers(spark, [(f"C{c}", "R", "2022-01-01", False, None) for c in range(20)]),
        accounts(spark, [(f"A{c}", f"C{c}", "P") for c in range(20)]),
        transactions(spark, many),
        small.monthly_revenue,
    )
    exports = scoring.run_exports(t, str(tmp_path))
    assert list(exports.named()) == ["rfm_segments", "churn_risk", "monthly_revenue", "kpi_summary"]
    for name, df in exports.named().items():
        back = storage.read_csv_table(spark, f"{tmp_path}/{name}", df.schema)
        assert rows(back) == rows(df)
    assert tuple(exports.churn_risk.columns) == scoring.CHURN_COLUMNS
    assert len(glob.glob(f"{tmp_path}/kpi_summary/*.csv")) == 1


def test_jdbc_scan_is_split_by_a_column():
    options = storage.jdbc_read_options("jdbc:x", "t", "transaction_date", "2023-01-01", "2024-06-30", 64, fetchsize="10000")
    assert options["partitionColumn"] == "transaction_date" and options["numPartitions"] == "64"
    assert options["fetchsize"] == "10000"


def test_jdbc_calls_pass_their_options_to_spark():
    """No database may be started here: this checks the calls, not a connection."""
    spark = mock.MagicMock()
    storage.read_jdbc_table(spark, url="jdbc:x", dbtable="t")
    spark.read.format.assert_called_once_with("jdbc")
    spark.read.format().options.assert_called_once_with(url="jdbc:x", dbtable="t")
    df = mock.MagicMock()
    storage.append_jdbc(df, "jdbc:x", "t", user="u")
    options = df.write.format().options
    options.assert_called_once_with(url="jdbc:x", dbtable="t", batchsize="1000", user="u")
    options().mode.assert_called_once_with("append")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.fresh_folder(spark, "x").startswith(session.shared_dir(spark))


@pytest.mark.parametrize(("named", "match"), [(None, "set spark.checkpoint.dir"), ("file:///tmp/x", "of its own"), ("/tmp/x", "of its own")])
def test_no_machine_local_folder_on_a_cluster(spark, named, match):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return named or default

    class Session:
        conf = Conf()
        sparkContext = Context()
        _jvm, _jsc = spark._jvm, spark._jsc

    with pytest.raises(RuntimeError, match=match):
        session.shared_dir(Session())


def cluster_on(spark, folder, paths_of=lambda paths: paths):
    """The session as one of a cluster that names ``folder``; its tasks look for ``paths_of`` what they are asked for."""
    context = mock.Mock(master="spark://here:7077", applicationId=str(folder), defaultParallelism=2)
    context.parallelize = lambda paths, tasks: spark.sparkContext.parallelize(paths_of(paths), tasks)
    session_ = mock.Mock(sparkContext=context, _jvm=spark._jvm)
    session_.conf.get = lambda key, default=None: str(folder)
    session_._jsc.hadoopConfiguration = spark._jsc.hadoopConfiguration
    session_._jsc.sc().isLocal.return_value = False
    return session_


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_a_mounted_folder_that_all_tasks_see_is_shared(spark, tmp_path, scheme):
    cluster = cluster_on(spark, f"{scheme}{tmp_path}/shared")
    assert session.shared_dir(cluster) == f"{scheme}{tmp_path}/shared"
    assert not glob.glob(f"{tmp_path}/shared/probe-*")
    cluster.sparkContext.parallelize = None  # asked once a session
    assert session.shared_dir(cluster) == f"{scheme}{tmp_path}/shared"


def test_a_folder_that_one_task_does_not_see_is_not_shared(spark, tmp_path):
    elsewhere = lambda paths: [*paths[:-1], f"{paths[-1]}-elsewhere"]
    for _ in range(2):
        with pytest.raises(RuntimeError, match="of its own"):
            session.shared_dir(cluster_on(spark, f"file://{tmp_path}/own", elsewhere))
    assert not glob.glob(f"{tmp_path}/own/probe-*")
