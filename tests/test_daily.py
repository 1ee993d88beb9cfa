import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_of

from tidemark.functions.sums import PARTS
from tidemark.operators.daily import (
    affected_dates,
    changes_by_date,
    daily_metrics,
    daily_metrics_with_mark,
    daily_metrics_with_state,
    daily_view,
    maintained_metrics,
    refresh,
    refreshed_metrics,
    restrict_to_dates,
)
from tidemark.spec import ORDER_EVENTS

STATE = "orderId string, customerId string, amount double, order_date date, ingest_timestamp timestamp"
METRICS = ["order_date", "totalOrders", "totalRevenue"]


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


FIRST = (
    ("1", "c1", 100.0, date(2023, 10, 27), datetime(2023, 10, 27, 10)),
    ("2", "c2", 150.0, date(2023, 10, 28), datetime(2023, 10, 28, 10)),
)
LATER = (
    ("3", "c3", 200.0, date(2023, 10, 28), datetime(2023, 10, 29, 9)),
    ("4", "c4", 300.0, date(2023, 10, 29), datetime(2023, 10, 29, 11)),
)


def test_daily_metrics(spark):
    rows = [("1", 100.0, date(2023, 10, 27)), ("2", 150.0, date(2023, 10, 27)), ("3", 200.0, date(2023, 10, 28)),
            (None, 5.0, date(2023, 10, 28))]
    df = spark.createDataFrame(rows, "orderId string, amount double, order_date date")
    assert rows_of(daily_metrics(df, ORDER_EVENTS), *METRICS) == [
        (date(2023, 10, 27), 2, 250.0),
        (date(2023, 10, 28), 1, 205.0),
    ]


def test_date_comes_from_the_time_in_older_tables(spark):
    df = spark.createDataFrame([("1", 2.0, datetime(2023, 10, 27, 9))], "orderId string, amount double, timestamp timestamp")
    assert rows_of(daily_metrics(df, ORDER_EVENTS), *METRICS) == [(date(2023, 10, 27), 1, 2.0)]


@pytest.mark.parametrize("detect", ["ingest", "exact"])
def test_only_affected_dates_are_refreshed(spark, detect):
    before = state(spark, *FIRST)
    gold = daily_metrics_with_mark(before, ORDER_EVENTS)
    after = state(spark, *FIRST, *LATER)
    dates = affected_dates(after, gold, ORDER_EVENTS, detect)
    assert rows_of(dates, "order_date") == [(date(2023, 10, 28),), (date(2023, 10, 29),)]
    assert rows_of(restrict_to_dates(after, dates, ORDER_EVENTS), "orderId") == [("2",), ("3",), ("4",)]
    assert rows_of(refresh(gold, after, dates, ORDER_EVENTS), *METRICS) == [
        (date(2023, 10, 27), 1, 100.0),
        (date(2023, 10, 28), 2, 350.0),
        (date(2023, 10, 29), 1, 300.0),
    ]


def test_full_refresh_without_metrics_or_without_their_mark(spark):
    df = state(spark, *FIRST)
    gold = daily_metrics_with_mark(df, ORDER_EVENTS)
    for earlier in (None, gold.drop("source_max_ingest_timestamp")):
        assert affected_dates(df, earlier, ORDER_EVENTS).count() == 2
    assert affected_dates(df, gold, ORDER_EVENTS).count() == 0


def test_exact_detection_equals_full_recompute_for_any_batches(spark):
    rng = random.Random(11)
    orders, gold = {}, None
    for run in range(4):
        arrived = datetime(2026, 1, 1) + timedelta(days=run)
        for _ in range(40):
            key = f"o{rng.randint(0, 60)}"
            orders[key] = (key, "c", float(rng.randint(1, 50)), date(2026, 2, rng.randint(1, 12)), arrived)
        now = state(spark, *orders.values())
        dates = affected_dates(now, gold, ORDER_EVENTS, "exact")
        fresh = refresh(gold, now, dates, ORDER_EVENTS, drop_empty=True).collect()
        gold = spark.createDataFrame(fresh, ORDER_EVENTS.daily_schema)
        assert rows_of(gold, *METRICS) == rows_of(daily_metrics(now, ORDER_EVENTS), *METRICS)
    view = daily_view(spark, now, ORDER_EVENTS)
    assert rows_of(view, *METRICS) == rows_of(gold, *METRICS)


def test_moved_order_is_missed_by_ingest_marks_and_found_by_exact(spark):
    before = state(spark, *FIRST)
    gold = daily_metrics_with_mark(before, ORDER_EVENTS)
    moved = state(spark, FIRST[0], ("2", "c2", 150.0, date(2023, 10, 30), datetime(2023, 10, 30, 1)))
    assert rows_of(affected_dates(moved, gold, ORDER_EVENTS), "order_date") == [(date(2023, 10, 30),)]
    assert rows_of(affected_dates(moved, gold, ORDER_EVENTS, "exact"), "order_date") == [
        (date(2023, 10, 28),), (date(2023, 10, 30),)
    ]


# metrics that follow from changes

CHANGES = f"{STATE}, _previous_date date, _previous_measure double, _previous_mark timestamp"
BEFORE = {"date": "_previous_date", "measure": "_previous_measure", "mark": "_previous_mark"}


def kept(spark, df):
    """Rows as they are now, without their history."""
    return spark.createDataFrame(df.collect(), df.schema)


def test_changes_give_the_metrics_of_a_full_recompute(spark):
    rng = random.Random(5)
    orders = {}
    day = lambda: date(2026, 2, rng.randint(1, 6))
    amount = lambda: rng.choice([0.1, 0.2, 1e16, -1e16, float(rng.randint(1, 9)), None, float("nan"), float("inf")][: rng.choice([5, 6, 8])])
    metrics, settled = None, 0
    for run in range(6):
        changes = []
        # the third run says it came before all others, so that latest marks are taken away
        arrived = datetime(2026, 1, 1) + timedelta(days=run if run != 3 else -9)
        for key in {f"o{rng.randint(0, 40)}" for _ in range(25)}:
            old = orders.get(key)
            orders[key] = (key, "c", amount(), day(), arrived)
            changes.append((*orders[key], *((old[3], old[2], old[4]) if old else (None, None, None))))
        now = state(spark, *orders.values())
        whole = kept(spark, daily_metrics_with_state(now, ORDER_EVENTS))
        if metrics is not None:
            delta = changes_by_date(spark.createDataFrame(changes, CHANGES), ORDER_EVENTS, BEFORE)
            fresh, again = maintained_metrics(metrics, delta, ORDER_EVENTS)
            again = kept(spark, again)
            fresh = kept(spark, fresh.unionByName(refreshed_metrics(now, again, ORDER_EVENTS)))
            rest = metrics.join(delta.select("order_date"), "order_date", "left_anti")
            metrics = kept(spark, rest.unionByName(fresh))
            columns = [*METRICS, "source_max_ingest_timestamp", "_rows"]
            assert repr(rows_of(metrics, *columns)) == repr(rows_of(whole, *columns))
            settled += delta.select("order_date").distinct().count() - again.count()
            assert run != 3 or again.count()
        else:
            metrics = whole
    assert settled > 10


def test_settled_dates_read_no_row_of_the_table(spark):
    metrics = daily_metrics_with_state(state(spark, *FIRST), ORDER_EVENTS)
    moved = ("2", "c2", 10.0, date(2023, 10, 27), datetime(2023, 10, 29), date(2023, 10, 28), 150.0, datetime(2023, 10, 28, 10))
    fresh, again = maintained_metrics(metrics, changes_by_date(spark.createDataFrame([moved], CHANGES), ORDER_EVENTS, BEFORE), ORDER_EVENTS)
    assert rows_of(fresh, *METRICS) == [(date(2023, 10, 27), 2, 110.0)]
    # the other date lost its latest mark, and as it happens its last row
    assert rows_of(again, "order_date") == [(date(2023, 10, 28),)]


def test_metrics_from_before_their_state_was_kept_are_read_again(spark):
    metrics = daily_metrics_with_state(state(spark, *FIRST), ORDER_EVENTS).withColumns(
        {"_rows": F.lit(None).cast("long"), "_sum_parts": F.lit(None).cast(PARTS)})
    change = ("9", "c", 1.0, date(2023, 10, 27), datetime(2023, 11, 1), None, None, None)
    _, again = maintained_metrics(metrics, changes_by_date(spark.createDataFrame([change], CHANGES), ORDER_EVENTS, BEFORE), ORDER_EVENTS)
    assert rows_of(again, "order_date") == [(date(2023, 10, 27),)]
