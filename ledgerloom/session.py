"""Session settings and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: (application, folder) that the tasks of a cluster were found to share
_SHARED: set[tuple[str, str]] = set()

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # no call-site capture for every expression: building a plan takes half the time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # one report compiles to some dozens of classes; the default of 100 makes a session that serves
    # many reports compile them again and again
    "spark.sql.codegen.cache.maxEntries": "2000",
    # checkpoints go when no query refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A one-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for durable intermediate data.

    Only a ``local`` session, where every task runs on this machine, may fall back to a temporary
    folder. A ``file:`` folder may be a mount that all machines share or a disk that each has of its own;
    the tasks of a cluster are asked which it is, once a session.
    """
    context = spark.sparkContext
    one_machine = context.master.startswith("local")
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named:
        if not one_machine and _is_local(spark, named) and not _seen_by_tasks(spark, named):
            raise RuntimeError(f"{CHECKPOINT_DIR} is {named}, a folder of each machine of its own")
        return named
    if not one_machine:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-checkpoints-")
    context.setCheckpointDir(folder)
    return folder


def _is_local(spark: SparkSession, folder: str) -> bool:
    """Whether the folder, by its scheme or the default one, lies on the machine's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def _seen_by_tasks(spark: SparkSession, folder: str) -> bool:
    """Whether the tasks of a cluster find a file that the driver puts into the folder.

    Two tasks a core look, so that every executor takes part; one that does not find it decides. A session without
    executors has nobody to ask.
    """
    if spark._jsc.sc().isLocal():
        return False
    context = spark.sparkContext
    if (context.applicationId, folder) in _SHARED:
        return True
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/probe-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.create(path).close()
    try:
        tasks = 2 * context.defaultParallelism
        found = all(context.parallelize([path.toUri().getPath()] * tasks, tasks).map(os.path.exists).collect())
    finally:
        files.delete(path, False)
    if found:
        _SHARED.add((context.applicationId, folder))
    return found


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, with its lineage cut.

    Readers of the result all see the same rows in the same partitions, also after executors are
    lost and tasks run again.
    """
    folder = shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
