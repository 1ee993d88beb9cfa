"""Fewer, larger files, and no files nobody reads any more."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import delete
from tidemark.sources.tables import SlicedTable, append, expired, file_sizes

FILE_BYTES = 256 * 1024 * 1024


def compact(df: DataFrame, total_bytes: int, *by: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """The same rows in as many partitions as files of the wanted size make."""
    files = max(1, math.ceil(total_bytes / file_bytes))
    return df.repartition(files, *by) if by else df.repartition(files)


def worth_it(files: Column, size: Column, file_bytes: int) -> Column:
    """Whether there are more files than the bytes need, less than half full on average.

    What :func:`compact` writes for the same bytes never is.
    """
    return (files > F.greatest(F.ceil(size / file_bytes), F.lit(1))) & (size < files * (file_bytes / 2))


def compact_slices(
    table: SlicedTable, file_bytes: int = FILE_BYTES, as_of: Column | None = None
) -> int | None:
    """Rewrite the slices that have more files than their bytes need."""
    now = table.snapshot()
    report = table.slice_sizes(now).filter(worth_it(F.col("files"), F.col("bytes"), file_bytes))
    chosen = report.select("_slice", F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1)).alias("_parts")).collect()
    if not chosen:
        return None
    slices = [r["_slice"] for r in chosen]
    # a slice larger than a file is spread over as many tasks as it needs files
    parts = table.spark.createDataFrame(chosen, "_slice string, _parts bigint")
    rows = table.read(slices, with_slice=True, snapshot=now)
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "_slice"]), F.col("_parts"))
    packed = rows.join(F.broadcast(parts), "_slice").withColumn("_part", spread)
    packed = packed.repartition(sum(r["_parts"] for r in chosen), "_slice", "_part").drop("_part", "_parts")
    return table.replace(packed, slices, kind="compact", as_of=as_of, snapshot=now)


def fold_slices(
    table: SlicedTable, file_bytes: int = FILE_BYTES, as_of: Column | None = None
) -> int | None:
    """Put the small slices of an append-only table together into one."""
    now = table.snapshot()
    report = table.slice_sizes(now).filter(F.col("bytes") < file_bytes).collect()
    if len(report) < 2:
        return None
    slices = [r["_slice"] for r in report]
    folded = f"fold-{now.version + 1}"
    total = sum(r["bytes"] for r in report)
    rows = compact(table.read(slices, snapshot=now), total, file_bytes=file_bytes)
    return table.replace(rows, slices, kind="compact", into=folded, as_of=as_of, snapshot=now)


def fold_plain(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, partition: str | None = None) -> int:
    """Put the files of a plain, append-only folder together; the number of files that went.

    The new files come first and the old ones go afterwards: a failure in between repeats rows, never
    loses one.  With ``partition`` the folder's parts are folded one into another's place.
    """
    files = file_sizes(spark, path)
    found = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    if not found.filter(worth_it(F.col("files"), F.col("bytes"), file_bytes)).count():
        return 0
    old, total = [r["path"] for r in files.select("path").collect()], found.first()["bytes"]
    rows = spark.read.parquet(path)
    if partition:
        folded = compact(rows.drop(partition), total, file_bytes=file_bytes)
        folded.write.mode("append").parquet(f"{path}/{partition}=folded-{uuid.uuid4().hex}")
    else:
        append(compact(rows, total, file_bytes=file_bytes), path)
    for file in old:
        delete(spark, file)
    return len(old)


def delete_expired(table: SlicedTable, hours: int, as_of: Column | None = None) -> list[str]:
    """Delete slice versions replaced longer ago than the retention allows, and forget them."""
    old = expired(table.versions().filter("slice IS NOT NULL"), hours, as_of).select("version", "slice", "rows").collect()
    if not old:
        return []
    gone = [f for f in (table.folder(r["version"], r["slice"]) for r in old if r["rows"]) if delete(table.spark, f)]
    table.forget([(r["version"], r["slice"]) for r in old])
    return gone
