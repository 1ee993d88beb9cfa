import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_of

from tidemark.operators.latest import deal, latest_per_key
from tidemark.operators.shape import evolve_state
from tidemark.operators.upsert import (
    merge_newer,
    replace_by_key,
    replace_by_legacy_key,
    supersedes,
)

SCHEMA = "k string, amount double, updated_at timestamp, event_version bigint, order_date date"
START = datetime(2026, 1, 1)


def merged_with(t, s, **options):
    return merge_newer(t, s, "k", supersedes("event_version", "updated_at"), **options)


def row(key, rng):
    moment = START + timedelta(hours=rng.randint(0, 48))
    return (key, float(rng.randint(1, 99)), moment, rng.choice([None, 1, 2, 3]), moment.date())


def newer(s, t):
    """The rule in plain Python."""
    if s[3] is not None:
        return t[3] is None or s[3] > t[3] or (s[3] == t[3] and s[2] > t[2])
    return s[2] > t[2]


def sides(spark, seed, n=400):
    rng = random.Random(seed)
    target = {f"k{i}": row(f"k{i}", rng) for i in range(n) if rng.random() < 0.6}
    source = {f"k{i}": row(f"k{i}", rng) for i in range(n) if rng.random() < 0.5}
    make = lambda d: spark.createDataFrame(list(d.values()), SCHEMA)
    return target, source, make(target), make(source)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_brute_force(spark, seed, small):
    target, source, t, s = sides(spark, seed)
    want = dict(target)
    change = {}
    for key, new in source.items():
        if key not in want:
            want[key], change[key] = new, ("insert", None)
        elif newer(new, want[key]):
            want[key], change[key] = new, ("update", want[key][4])
    merged = merged_with(t, s, track_date="order_date", source_is_small=small)
    columns = ["k", "amount", "updated_at", "event_version", "order_date"]
    assert rows_of(merged, *columns) == sorted(want.values(), key=repr)
    changed = merged.filter("_change IS NOT NULL").select("k", "_change", "_previous_date").collect()
    assert {r[0]: (r[1], r[2]) for r in changed} == change


def test_merging_a_batch_twice_changes_nothing(spark):
    _, _, t, s = sides(spark, 3)
    once = merged_with(t, s)
    twice = merged_with(once, s)
    assert rows_of(once, "*") == rows_of(twice, "*")


def test_unversioned_event_replaces_by_time_alone(spark):
    t = spark.createDataFrame([("a", 1.0, START, 5, START.date())], SCHEMA)
    later = START + timedelta(hours=1)
    s = spark.createDataFrame([("a", 2.0, later, None, later.date())], SCHEMA)
    assert merged_with(t, s).first()["event_version"] is None


def test_unknown_update_time_of_the_target_keeps_it(spark):
    t = spark.createDataFrame([("a", 1.0, None, None, START.date())], SCHEMA)
    s = spark.createDataFrame([("a", 2.0, START, None, START.date())], SCHEMA)
    assert merged_with(t, s).first()["amount"] == 1.0


def test_latest_with_one_key_holding_most_rows(spark):
    rng = random.Random(5)
    rows = [row("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 200)}", rng) for _ in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    none_last = lambda v: (v is not None, v if v is not None else 0)
    want = {}
    for r in rows:
        rank = (r[2], none_last(r[3]), r[1])
        if r[0] not in want or rank > want[r[0]][0]:
            want[r[0]] = (rank, r)
    got = latest_per_key(df, "k", ["updated_at", "event_version"])
    assert rows_of(got, "*") == sorted((r for _, r in want.values()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # cut to a row per key before the shuffle and again after it
    assert plan.count("WindowGroupLimit") == 2


def test_latest_does_not_sort_a_whole_split_in_one_task(spark):
    """One input split, most of it one key: what is sorted comes in parts of the advisory size."""
    rng = random.Random(6)
    rows = [row("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 2000)}", rng) for _ in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    sizes = [f"spark.sql.adaptive.{name}" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    before = {size: spark.conf.get(size) for size in sizes}
    for size in sizes:
        spark.conf.set(size, "16k")
    try:
        dealt = deal(df, *df.columns).groupBy(F.spark_partition_id()).count().collect()
        got = latest_per_key(df, "k", ["updated_at", "event_version"], any_splits=True)
        same = rows_of(got, "*") == rows_of(latest_per_key(df, "k", ["updated_at", "event_version"]), "*")
    finally:
        for size in sizes:
            spark.conf.set(size, before[size])
    assert sum(r["count"] for r in dealt) == 20_000 and max(r["count"] for r in dealt) < 4_000
    assert same
    # dealt before the first sort, and each key still cut to a row per task before the shuffle on it
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.rindex("REBALANCE_PARTITIONS_BY_COL") > plan.rindex("WindowGroupLimit")


def test_evolving_fills_update_time(spark):
    old = spark.createDataFrame(
        [("a", datetime(2026, 1, 1), datetime(2026, 1, 2)), ("b", None, datetime(2026, 1, 3))],
        "k string, timestamp timestamp, ingest_timestamp timestamp",
    )
    got = evolve_state(old, "updated_at", "event_version", "timestamp", "ingest_timestamp")
    assert rows_of(got, "k", "updated_at", "event_version") == [
        ("a", datetime(2026, 1, 1), None),
        ("b", datetime(2026, 1, 3), None),
    ]


def test_replacing_by_key_and_by_old_key_name(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "day string, n int")
    want = [("a", 1), ("b", 20), ("c", 30)]
    assert rows_of(replace_by_key(target, source, "day"), "day", "n") == want
    legacy = target.withColumnRenamed("day", "timestamp")
    got = replace_by_legacy_key(legacy, source.withColumn("extra", F.lit(1)), "day", "timestamp")
    assert rows_of(got, "timestamp", "n") == want
