"""Session settings and the shared working folder."""

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # blocks of vectors and long texts do not pile up in a Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    # ranks are limited in each task before the shuffle, however large the limit
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    # float rollups keep more groups per task than the default 128 before they sort
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime settings to a session.

    Python workers on this machine find the package by the path set here; on a cluster it is
    installed or shipped with ``--py-files``.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


@contextmanager
def writing(spark: SparkSession, writers: int = 0) -> Iterator[None]:
    """Session settings for a write whose plan runs once.

    Its shuffle files go when it ends, so the disk holds those of one step, not of all steps.
    With ``writers`` a task keeps that many files of a partitioned table open, so rows that need
    no order are not sorted by partition first, nor spilled.
    """
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if writers:
        settings["spark.sql.maxConcurrentOutputFileWriters"] = str(writers)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("profilelake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folder: list[tempfile.TemporaryDirectory] = []


def work_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir`` of the session.

    Where the session names none and runs on one machine, as in tests, it is a temporary folder
    that goes away with the process; on a cluster other machines would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.TemporaryDirectory(prefix="profilelake-"))
        folder = _local_folder[0].name
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below ``work_dir`` that no other run uses."""
    return f"{work_dir(spark)}/profilelake/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Give every core a share of a narrow input that few splits hold.

    Meant for rows about to grow (generated arrays, tokens). An input with at least as many
    splits as the cluster has cores is left alone and not shuffled. With ``rows`` all rows are
    dealt evenly, at most about that many to a task: splits are cut by bytes, and of a file with
    few row groups most are empty. For files the count reads their footers only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        return df.repartition(max(cores, -(-df.count() // rows)))
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
