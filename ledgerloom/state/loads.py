"""Loads of CSV batches that may run again: each batch ends up in the tables once.

The four tables are :class:`~ledgerloom.state.batches.BatchTable` folders. Files are staged and audited together with what is stored;
then the tables take the batch one after the other, dimensions before the facts that refer to them. Rows of the dimensions
whose keys are stored already are left out, as keys of a database would refuse them; facts have no key, so the batch id alone
tells what is loaded. A load that broke between two tables goes on where it stopped when it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.quality import integrity_audit
from ledgerloom.session import durable
from ledgerloom.sources import storage
from ledgerloom.sources.schemas import PRIMARY_KEYS, SCHEMAS, Tables
from ledgerloom.state.batches import BatchTable


def loaded_table(spark: SparkSession, folder: str, name: str) -> BatchTable:
    """One of the four tables, laid out like :func:`ledgerloom.sources.storage.write_table` does it."""
    schema = SCHEMAS[name]
    return BatchTable(spark, f"{folder}/{name}", schema, lambda df, path: storage.write_table(df, path, name))


def read_loaded(spark: SparkSession, folder: str) -> Tables:
    return Tables(**{name: loaded_table(spark, folder, name).read() for name in SCHEMAS})


def add_batch(spark: SparkSession, folder: str, batch: str, name: str, df: DataFrame) -> bool:
    """Appends a batch to one table unless it is there."""
    key = PRIMARY_KEYS.get(name)
    return loaded_table(spark, folder, name).append(batch, df, [key] if key else [])


def load_batch(
    spark: SparkSession,
    raw_folder: str,
    folder: str,
    batch: str,
    strict: bool = False,
    multi_line: bool | None = None,
) -> tuple[dict[str, bool], DataFrame]:
    """CSV files into the tables, once per batch id. Returns which tables took it now, and the integrity report.

    The report is on the stored tables with the batch. With ``strict`` a violated rule raises
    :class:`~ledgerloom.sources.storage.IntegrityError` before anything is published.
    """
    raw = storage.read_csv_tables(spark, raw_folder, multi_line).named()
    raw["customers"] = storage.with_defaults(raw["customers"])
    with storage.scratch_folder(spark, "staged") as staging:
        storage.write_tables(Tables(**raw), staging)
        staged = storage.read_tables(spark, staging).named()
        whole = {}
        for name, df in staged.items():
            table = loaded_table(spark, folder, name)
            known = table.batches()
            there = any(b.batch == batch for b in known)
            stored = table.read(known)
            whole[name] = stored if there else stored.unionByName(df)
        audit = durable(integrity_audit(whole))
        if strict:
            broken = audit.filter(F.col("violations") > 0).collect()  # at most one row per rule
            if broken:
                raise storage.IntegrityError([tuple(row) for row in broken])
        taken = {name: add_batch(spark, folder, batch, name, df) for name, df in staged.items()}
    return taken, audit

