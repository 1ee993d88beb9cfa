"""Read-only questions people ask of the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one line each."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def lookup(df: DataFrame, key: str, values: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of the given keys, in key order."""
    wanted = F.col(key) == values[0] if len(values) == 1 else F.col(key).isin(list(values))
    return df.filter(wanted).select(*columns).orderBy(key)


def newest_first(df: DataFrame, time: str, columns: Sequence[str], *ties: str) -> DataFrame:
    return df.orderBy(F.desc(time), *ties).select(*columns)
