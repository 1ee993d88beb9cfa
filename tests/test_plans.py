"""What Spark makes of the operators: shuffles, pushdown, generated code."""

import re

import pytest
from pyspark.sql import functions as F
from tests.helpers import events
from tests.test_pipeline import lake_at, put

from tidemark.operators import contract, daily, upsert
from tidemark.operators.latest import latest_per_key
from tidemark.plans import silver
from tidemark.spec import ORDER_EVENTS, Contract


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Bronze and Silver on disk."""
    lake = lake_at(spark, tmp_path_factory.mktemp("plans"))
    rows = [(f"o{i % 50}", "c", float(i + 1), f"2026-01-{i % 28 + 1:02d}", f"2026-02-{i % 28 + 1:02d}", i) for i in range(300)]
    put(lake, events(spark, *rows).repartition(4), "one")
    silver.process(lake)
    return lake


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_times_are_parsed_in_one_place_and_in_generated_code(stored):
    df = contract.clean(stored.bronze.read(), ORDER_EVENTS, Contract())
    text = plan(df)
    assert text.count("Exchange") == 0
    # five formats, two columns, each written once in the plan
    assert text.count("try_to_timestamp") == 10
    assert not re.search(r"^\s*(\+-|:-)?\s*(Filter|Project|Generate)", text, re.M)


def test_latest_shuffles_once_after_cutting_each_key_to_a_row(stored):
    df = latest_per_key(stored.bronze.read(), "orderId", ["ingest_timestamp"])
    text = plan(df)
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2


def test_merge_shuffles_each_side_once(spark, stored):
    target = stored.silver.read(with_slice=True).repartition(8, "_slice")
    source = stored.silver.read(with_slice=True).repartition(8, "_slice")
    merged = upsert.merge_newer(
        target, source, "orderId", upsert.supersedes("event_version", "updated_at"), ["_slice"]
    )
    text = plan(merged)
    assert text.count("Exchange") == 2 and "FullOuter" in text


def test_small_batch_leaves_the_target_in_place(stored):
    target, source = stored.silver.read(), stored.silver.read()
    merged = upsert.merge_newer(
        target, source, "orderId", upsert.supersedes("event_version", "updated_at"), source_is_small=True
    )
    text = plan(merged)
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_metrics_read_few_columns_and_combine_before_the_shuffle(stored):
    text = plan(daily.daily_metrics(stored.silver.read(), ORDER_EVENTS))
    assert "ReadSchema: struct<orderId:string,amount:double,order_date:date>" in text
    # orders are added up to a row per date and bin in each task; then a few bins per date meet
    first, second = text.split("Exchange")[1:]
    assert "partial_sum" in text.split("Exchange")[1] or "partial_sum" in first
    assert "partial_count" in second


def test_refresh_pushes_the_dates_to_the_files(spark, stored):
    state = stored.silver.read().filter(F.col("order_date").isin([F.lit("2026-01-03").cast("date")]))
    dates = spark.createDataFrame([("2026-01-03",)], "d string").select(F.col("d").cast("date").alias("order_date"))
    text = plan(daily.refreshed_metrics(state, dates, ORDER_EVENTS))
    assert re.search(r"PushedFilters: \[.*EqualTo\(order_date,2026-01-03\)", text)


def test_heavy_date_is_summed_before_it_meets_the_dates(spark, stored):
    """Without a broadcast, orders are not moved by date: their sums are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = stored.silver.read()
        text = plan(daily.refreshed_metrics(state, state.select("order_date").distinct(), ORDER_EVENTS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("LeftSemi")
    assert "partial_count" in text[join:]


def test_only_new_bronze_files_are_read(spark, stored):
    put(stored, events(spark, ("n", "c", 1.0, "2026-01-01", "2026-01-01", 1)), "later")
    seen = stored.silver.snapshot().source_version
    fresh = stored.bronze.written_since(seen, "append")
    assert fresh.count() == 1
    assert all("_slice=later" in f for f in fresh.inputFiles())


def scanned_rows(spark, df) -> int:
    """Rows that the reader handed on, before any filter of Spark's."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = df.select("order_date")._jdf.queryExecution()
        executed.toRdd().count()
        return executed.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ranges_of_dates_skip_what_lies_between(spark, tmp_path):
    """One old and one new date read their own rows, not the years between them."""
    days = spark.range(1000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"))
    days.repartitionByRange(50, "order_date").sortWithinPartitions("order_date").write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    wanted = spark.createDataFrame([("2020-01-03",), ("2022-09-01",), (None,)], "d string").select(F.col("d").cast("date").alias("order_date"))
    ranges = daily.date_ranges(wanted, "order_date")
    assert [tuple(map(str, r)) for r in ranges] == [("2020-01-03",) * 2, ("2022-09-01",) * 2]
    some = state.filter(daily.in_ranges(F.col("order_date"), ranges))
    assert some.count() == 2
    assert scanned_rows(spark, some) <= 60 < scanned_rows(spark, state)


@pytest.mark.parametrize("most", [1, 2, 3, 32])
def test_ranges_hold_every_date_and_stay_few(spark, most):
    texts = ["2020-01-01", "2020-01-02", "2020-01-03", "2020-02-01", "2021-02-01", "2021-02-03", "2021-02-03"]
    dates = spark.createDataFrame([(t,) for t in texts], "d string").select(F.col("d").cast("date").alias("d"))
    ranges = daily.date_ranges(dates, "d", most)
    assert len(ranges) == min(most, 4)
    assert all(any(str(a) <= t <= str(b) for a, b in ranges) for t in texts)
    # the widest gaps part them
    assert most == 1 or not any(str(a) <= "2020-08-01" <= str(b) for a, b in ranges)
    assert daily.date_ranges(dates.limit(0), "d") == []
    assert dates.filter(daily.in_ranges(F.col("d"), [])).count() == 0
