"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # zone-less timestamps and dates mean UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets a join on (slice, key) reuse a shuffle on the slice alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session without that setting gets a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def keep(df: DataFrame, purpose: str = "kept") -> DataFrame:
    """Write ``df`` out and read it back: later steps start from the files.

    The files go when the driver's process ends, as results may be read until then.
    """
    folder = scratch_dir(df.sparkSession, purpose)
    forget_later(df.sparkSession, folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_kept: list[tuple[SparkSession, str]] = []


def forget_later(spark: SparkSession, folder: str) -> str:
    """Delete ``folder`` when the driver's process ends."""
    _kept.append((spark, folder))
    return folder


@atexit.register
def _delete_kept() -> None:
    for spark, folder in _kept:
        with suppress(Exception):  # the session may be gone already
            delete(spark, folder)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder for the time of a block."""
    folder = scratch_dir(spark, purpose)
    try:
        yield folder
    finally:
        delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(path) and files.delete(path, True)
