"""Bringing older tables to the columns the operators expect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def backfill_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each missing column as a typed NULL.  Names are compared exactly."""
    missing = {n: F.lit(None).cast(kind) for n, kind in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def derive_date(df: DataFrame, date: str, from_time: str) -> DataFrame:
    """Older tables carry only the event time: take the date from there."""
    if date in df.columns or from_time not in df.columns:
        return df
    return df.withColumn(date, F.to_date(from_time))


def evolve_state(
    df: DataFrame, updated_as: str, version_as: str, event_time: str, mark: str
) -> DataFrame:
    """Give a keyed table without change tracking its two missing columns.

    An unset update time becomes the event time, else the ingest time.
    """
    df = backfill_columns(df, {updated_as: "timestamp", version_as: "bigint"})
    known = [F.col(updated_as)]
    if event_time in df.columns:
        known.append(F.col(event_time).cast("timestamp"))
    if mark in df.columns:
        known.append(F.col(mark))
    return df.withColumn(updated_as, F.coalesce(*known))


def with_ingest_time(df: DataFrame, mark: str, as_of=None) -> DataFrame:
    return df.withColumn(mark, F.current_timestamp() if as_of is None else as_of)
