"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="callmeter-"))
    return context.getCheckpointDir()


_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder that nothing else uses; inside scratch() it is deleted with the rest."""
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was stored inside, which must have been used by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Spark's switch for removing the shuffle files of an action at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action inside go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the
    disk holds those of many actions at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if before == "true":  # so it is, or another writer in this session restores it
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows once and reads them back.

    For results that several later steps read: the steps then scan columns of
    a table instead of repeating the work, also after the loss of an executor.
    Inside scratch() the table lives as long as that; outside, the caller
    decides when the checkpoint folder is cleared.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
