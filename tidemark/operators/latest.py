"""The newest event of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DataType, MapType, VariantType

#: Parts that rows are dealt to by a hash; small ones are put together by their size.
#: Up to this number Spark writes a shuffle straight to files and holds no rows for it.
DEALT = 200


def latest_per_key(
    events: DataFrame, key: str | Sequence[str], newest_first: Sequence[str], any_splits: bool = False
) -> DataFrame:
    """One row per key: the first by ``newest_first``, descending, NULLs last.

    Spark cuts each key to one row per task before the shuffle, so a key with
    very many events sends only as many rows as there are input tasks.  The
    remaining columns break ties, which makes the winner the same on every run.

    A task sorts all its rows for that.  ``any_splits`` is for events whose splits may be large, such as
    a file of one row group: they are dealt to tasks of limited size first, which costs a shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ties = [
        f.name
        for f in events.schema
        if f.name not in (*keys, *newest_first) and _sortable(f.dataType)
    ]
    order = [F.desc_nulls_last(c) for c in (*newest_first, *ties)]
    if any_splits:
        events = deal(events, *keys, *newest_first, *ties)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return events.withColumn("_place", place).filter("_place = 1").drop("_place")


def deal(rows: DataFrame, *by: str) -> DataFrame:
    """The same rows in tasks of about the session's advisory size; equal values of ``by`` go the same way."""
    return rows.hint("rebalance", DEALT, *by)


def _sortable(kind: DataType) -> bool:
    return not isinstance(kind, (MapType, VariantType))
