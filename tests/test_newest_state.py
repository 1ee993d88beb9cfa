"""Newest event per key as streaming state, against the batch operator."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from tests.helpers import rows_of
from tests.test_pipeline import lake_at
from tidemark.operators.latest import latest_per_key
from tidemark.streaming.newest import merge_newest, newest_per_key, rank, stream_settings

SCHEMA = "k string, version bigint, updated timestamp, amount double"
ORDER = ["version", "updated", "amount"]


@pytest.fixture
def state_store(spark):
    with stream_settings(spark):
        yield


def passed(spark, folder, out, checkpoint, **options):
    """Rows that pass, with the batch they came in."""
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        newest_per_key(events, "k", ORDER, **options)
        .writeStream.outputMode("update")
        .foreachBatch(lambda rows, n: rows.withColumn("batch", F.lit(n)).write.mode("append").parquet(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(f"{SCHEMA}, batch bigint").parquet(out)


def test_shuffled_arrivals_end_as_the_batch_does(spark, tmp_path, state_store):
    pick = random.Random(3)
    start = datetime(2026, 1, 1)
    rows = [
        (
            pick.choice([f"k{i}" for i in range(12)] + [None, "hot", "hot", "hot"]),
            pick.choice([None, 1, 2, 3]),
            pick.choice([None, start + timedelta(microseconds=pick.randrange(5))]),
            pick.choice([None, float("nan"), -1.0, pick.random()]),
        )
        for _ in range(240)
    ]
    raw, out, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "checkpoint"))
    want = latest_per_key(spark.createDataFrame(rows, SCHEMA).filter("k IS NOT NULL"), "k", ORDER)
    for part in range(2):
        spark.createDataFrame(rows[part::3], SCHEMA).coalesce(1).write.mode("append").parquet(raw)
    passed(spark, raw, out, checkpoint)
    # a later run goes on from the state of the one before
    spark.createDataFrame(rows[2::3], SCHEMA).coalesce(1).write.mode("append").parquet(raw)
    got = passed(spark, raw, out, checkpoint)
    last = got.withColumn("n", F.max("batch").over(Window.partitionBy("k"))).filter("n = batch")
    columns = ("k", "version", "updated", F.col("amount").cast("string"))
    assert rows_of(last, *columns) == rows_of(want, *columns)
    assert got.groupBy("k", "batch").count().filter("count > 1").count() == 0


def test_order_is_that_of_spark(spark):
    rows = [(None, 1.0), ("a", None), ("ß", float("nan")), ("ß", 2.0), ("z", -0.5), ("", float("inf"))]
    frame = spark.createDataFrame(rows, "t string, x double")
    want = [tuple(r) for r in frame.orderBy(F.asc_nulls_first("t"), F.asc_nulls_first("x")).collect()]
    assert repr(sorted(rows, key=rank)) == repr(want)


def test_late_and_repeated_events_rewrite_nothing(spark, tmp_path):
    lake = lake_at(spark, tmp_path, batch_order="version")
    schema = lake.entity.state_schema
    day = lambda n: datetime(2026, 1, n)

    def arrive(*rows):
        values = [("a", "c", amount, day(1), day(1), day(updated), version, day(1).date()) for amount, updated, version in rows]
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        merge_newest(lake, events, str(tmp_path / "state"))
        return lake.silver.snapshot().version, rows_of(lake.silver.read(), "amount", "event_version")

    assert arrive((1.0, 1, 1), (2.0, 2, 2)) == (1, [(2.0, 2)])
    assert arrive((1.0, 1, 1), (2.0, 2, 2), (9.0, 5, 1)) == (1, [(2.0, 2)])
    assert arrive((3.0, 3, 3)) == (2, [(3.0, 3)])
    with pytest.raises(ValueError, match="batch_order"):
        merge_newest(lake_at(spark, tmp_path), spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "unused")


def test_state_stays_in_spark(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    plan = newest_per_key(events, "k", ORDER)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Py" not in plan


@pytest.mark.parametrize("ttl_hours, at_last", [(168, [1.0]), (0, [])])
def test_a_key_is_forgotten_after_its_time(spark, tmp_path, monkeypatch, state_store, ttl_hours, at_last):
    raw, checkpoint = (str(tmp_path / n) for n in ("raw", "checkpoint"))
    spark.createDataFrame([("a", 2, None, 9.0)], SCHEMA).coalesce(1).write.mode("append").parquet(raw)

    def run_after(hours, *amounts):
        moment = F.lit(datetime(2026, 3, 2, 5) + timedelta(hours=hours)).cast("timestamp")
        with monkeypatch.context() as m:
            m.setattr(F, "current_timestamp", lambda: moment)
            for amount in amounts:
                spark.createDataFrame([("a", 1, None, amount)], SCHEMA).coalesce(1).write.mode("append").parquet(raw)
            got = passed(spark, raw, str(tmp_path / f"out-{hours}"), checkpoint, ttl_hours=ttl_hours)
            return sorted(r["amount"] for r in got.collect())

    assert run_after(0) == [9.0]
    assert run_after(100, 1.0) == run_after(167, 1.0) == []
    assert run_after(167 + 2 * 168, 1.0) == at_last
