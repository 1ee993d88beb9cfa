"""Merging a batch into a keyed table, as functions of two DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

CHANGE = "_change"
PREVIOUS_DATE = "_previous_date"
# what metrics need to take a replaced row back
PREVIOUS_MEASURE, PREVIOUS_MARK = "_previous_measure", "_previous_mark"
INSERTED, UPDATED = "insert", "update"
# largest batch that is sent whole to every executor
BROADCAST_BYTES = 32 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Upper bound of what a row of plain columns takes in memory."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    fixed = 16 * len(df.columns) + 16
    return sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(fixed))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all rows together stay within ``limit``; measures every one of them."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0] <= limit


def supersedes(version: str, updated: str, source: str = "s", target: str = "t") -> Column:
    """Whether the source row replaces the target row.

    A versioned event beats an unversioned row, then the higher version wins,
    then the later update.  An unversioned event is judged by its update time
    alone.  Anything unknown keeps the target.
    """
    sv, tv = F.col(f"{source}.{version}"), F.col(f"{target}.{version}")
    later = F.col(f"{source}.{updated}") > F.col(f"{target}.{updated}")
    by_version = tv.isNull() | (sv > tv) | ((sv == tv) & later)
    return F.coalesce(F.when(sv.isNotNull(), by_version).otherwise(later), F.lit(False))


def merge_newer(
    target: DataFrame,
    source: DataFrame,
    key: str,
    wins: Column,
    cluster_by: Sequence[str] = (),
    track_date: str | None = None,
    source_is_small: bool = False,
    track: Mapping[str, str] | None = None,
) -> DataFrame:
    """Target after the batch: newer source rows replace, unknown keys are added.

    Both sides hold each key at most once.  ``wins`` reads the sides as ``s`` and
    ``t``.  ``cluster_by`` names columns that follow from the key and that both
    sides are stored by; joining on them too lets Spark reuse that layout.
    With ``track_date`` each changed row says how it changed and which date it had; ``track`` names columns
    for further values that a replaced row had.

    Both sides are shuffled once.  For a batch that ``fits_broadcast``,
    ``source_is_small`` leaves the target where it is: it looks the batch up in
    place, and only keys that found their match are compared again.
    """
    on = [*cluster_by, key]
    columns = [c for c in target.columns if c not in on]
    s = source.select(*on, *columns).withColumn("_in_source", F.lit(True)).alias("s")
    t = target.withColumn("_in_target", F.lit(True)).alias("t")

    tracked = {PREVIOUS_DATE: track_date, **(track or {})} if track_date else {}
    if source_is_small:
        kept = _combine(t.join(F.broadcast(s), on, "left"), on, columns, wins, tracked)
        known = target.join(F.broadcast(source.select(*on)), on, "left_semi").select(*on)
        new = source.join(F.broadcast(known), on, "left_anti").select(*on, *columns)
        if tracked:
            new = new.withColumns({CHANGE: F.lit(INSERTED), **_nothing_before(target, tracked)})
        return kept.unionByName(new)
    return _combine(t.join(s, on, "full_outer"), on, columns, wins, tracked)


def _nothing_before(rows: DataFrame, tracked: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.lit(None).cast(rows.schema[of].dataType) for name, of in tracked.items()}


def all_inserted(rows: DataFrame, track_date: str, track: Mapping[str, str] | None = None) -> DataFrame:
    """A first batch, in the columns of a merge that tracks changes."""
    return rows.withColumns({CHANGE: F.lit(INSERTED), **_nothing_before(rows, {PREVIOUS_DATE: track_date, **(track or {})})})


def _combine(joined, on, columns, wins, tracked) -> DataFrame:
    added = F.col("_in_target").isNull()
    replaced = F.col("_in_target") & F.coalesce(F.col("_in_source"), F.lit(False)) & wins
    joined = joined.withColumns({"_added": added, "_replaced": F.coalesce(replaced, F.lit(False))})
    take_source = F.col("_added") | F.col("_replaced")
    picked = [F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns]
    if tracked:
        picked.append(
            F.when(F.col("_added"), INSERTED).when(F.col("_replaced"), UPDATED).alias(CHANGE)
        )
        picked += [F.when(F.col("_replaced"), F.col(f"t.{of}")).alias(name) for name, of in tracked.items()]
    return joined.select(*on, *picked)


def replace_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows, plus the target rows whose key the source does not have."""
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def replace_by_legacy_key(target: DataFrame, source: DataFrame, key: str, legacy_key: str) -> DataFrame:
    """The same for a target that still keeps the key under its old name."""
    renamed = source.withColumn(legacy_key, F.col(key)).select(
        *[c for c in (*target.columns,) if c in (*source.columns, legacy_key)]
    )
    return replace_by_key(target, renamed, legacy_key)
