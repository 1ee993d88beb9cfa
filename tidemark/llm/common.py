"""What several operators need: workers that find this package, documents as the operators read them."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever the driver was started.

    On a cluster the package is installed, or sent with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    path = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in path:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *path])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and the columns named; nothing else is read."""
    return documents.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def small(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows a few at a time, so that a worker never holds ten thousand texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows, with at most about ``most`` bytes of a text column at a time, or a single row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            past = max(at + 1, int(np.searchsorted(ends, most + (ends[at - 1] if at else 0), "right")))
            yield batch.slice(at, past - at)
            at = past


def dealt(rows: int, per_task: int) -> int:
    """Number of partitions that leaves about ``per_task`` rows in each."""
    return max(1, -(-rows // per_task))


def uniform(*columns: Column | str) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)
