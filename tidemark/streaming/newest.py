"""The newest event of each key as state of a stream."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.plans.lake import Lake
from tidemark.plans.silver import merge_batch
from tidemark.session import scratch

ARRIVED = "_arrived"
# how far a clock may step back between two batches without an event counting as too late for its span
CLOCK_SLACK = "1 hour"
# The state store that keeps state outside the heap; and without the second, a query that stops when
# it has read all there is could go on with batches of nothing to expire state.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def rank(values: Sequence[Any]) -> tuple:
    """Orders rows as Spark does, unknown values lowest and NaN highest, texts by their bytes."""

    def one(value: Any) -> tuple:
        if value is None:
            return (0, 0)
        if isinstance(value, float) and math.isnan(value):
            return (2, 0)
        return (1, value.encode() if isinstance(value, str) else value)

    return tuple(one(v) for v in values)


def newest_per_key(events: DataFrame, key: str, newest_first: Sequence[str], ttl_hours: int = 168) -> DataFrame:
    """The events of a stream that are newer than all of their key before them, at most one per key and batch.

    Order is that of :func:`tidemark.operators.latest.latest_per_key` by ``newest_first`` alone: of events
    equal in all of it the first to arrive stays.  The state is Spark's own, of an aggregation: the newest event of each
    key and the time of the batch it came in, so a batch passes on the keys whose newest is its own.  A key
    is forgotten between ``ttl_hours`` and twice that after its last event (0: never), and its next event passes, so a table
    that follows must still refuse older events, as the merge does.  For that each key has state in two spans of
    twice ``ttl_hours``, a new one beginning every ``ttl_hours``; the older of the two decides.  Needs
    :data:`STREAM_SETTINGS` in the session.  An event without a key is none's and is left out.  A column ``_arrived`` of
    the events would be lost.
    """
    # one moment for a whole batch, also when Spark repeats it
    now = F.current_timestamp()
    arrived = events.filter(events[key].isNotNull()).withColumn(ARRIVED, now)
    order = F.struct(*newest_first, -F.unix_micros(ARRIVED))
    best = F.max_by(F.struct(*arrived.columns), order).alias("best")
    if ttl_hours:
        ttl = F.make_dt_interval(hours=F.lit(ttl_hours))
        span = F.window(ARRIVED, f"{2 * ttl_hours} hours", f"{ttl_hours} hours").alias("span")
        held = arrived.withWatermark(ARRIVED, CLOCK_SLACK).groupBy(key, span).agg(best)
        # one comparison: a filter on the span alone would go below the aggregation, and the younger span would hold nothing
        now = F.when(F.col("span.start") <= now - ttl, now)
    else:
        held = arrived.groupBy(key).agg(best)
    return held.filter(F.col(f"best.{ARRIVED}") == now).select("best.*").select(*events.columns)


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """:data:`STREAM_SETTINGS` for the queries that start within a block."""
    before = {name: spark.conf.get(name, None) for name in STREAM_SETTINGS}
    for name, value in STREAM_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def merge_newest(lake: Lake, events: DataFrame, checkpoint: str, as_of: Column | None = None, ttl_hours: int = 168) -> None:
    """Bring the keyed table up to date with a stream of accepted events; stops when all there is has been read.

    Only events newer than all of their key before them reach the merge, so late and repeated ones rewrite no
    slice.  The settings' ``batch_order`` must be "version", the order of the merge: with another one the state
    would hold back what the table takes.  A batch that Spark repeats is merged again, which changes nothing.
    """
    contract = lake.settings.contract
    if contract.batch_order != "version":
        raise ValueError('keyed state orders events as the merge does: set batch_order="version"')

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch(lake.spark, "newest") as folder:
            batch.write.parquet(folder)
            rows = lake.spark.read.schema(batch.schema).parquet(folder)
            if not rows.isEmpty():
                merge_batch(lake, lake.silver, rows, as_of=as_of)

    newest = newest_per_key(events, lake.entity.key, lake.entity.newest_first(contract), ttl_hours)
    with stream_settings(lake.spark):
        query = (
            newest.writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
