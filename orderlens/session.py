"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Rows laid out by (entity, order code) also serve the join on those keys plus the date, so
    # one shuffle of the wide order rows is enough for both joins.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A hot order key is still split at run time; only then is the second shuffle paid.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every looked-up partition turns out this small it is hashed, and the wide rows are
    # not sorted; larger ones keep the sort-merge join, which can spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster session must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlens-"))
    return spark.sparkContext.getCheckpointDir()


_SCOPES: list[list[str]] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """New path in the shared folder, under the application's id."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end; results must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in _SCOPES.pop():
            made = folder(path)
            made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(made, True)


#: Whether a query's shuffle files go at its end; by default they stay until the driver happens to collect the query.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Writes made inside delete their shuffle files once their rows are stored.

    A write has a plan of its own that nothing runs again, so the files serve no one, and without this the disks
    hold the shuffles of all steps at once. Frames that a caller runs keep theirs: it may run them twice.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later branches read the same rows instead of recomputing them, a lost executor costs
    one file read, and the optimizer knows the true size when it considers a broadcast.
    """
    path = shared_path(df.sparkSession, label)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
