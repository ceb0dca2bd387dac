"""Session helpers: time zone, the shared folder, and materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone so that date parts do not depend on the machine."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the length of a ``with`` block; the caller's own comes back after it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediates, once no frame needs them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where a result feeds several later jobs: the work is done once, the
    lineage ends here, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scanned frame over at least as many partitions as there are cores.

    For costly per-row work on input that sits in few files. Input of many files
    already has enough partitions and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
