"""The keyed table in buckets: same rows as the plain merge, and only the batch is shuffled."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.test_merge import merged_with, sides

from tidemark.operators.upsert import supersedes
from tidemark.sources.bucketed import BucketedTable


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "t"), "k", 4)
    yield made
    made.drop()


def wins():
    return supersedes("event_version", "updated_at")


def rows(df):
    return sorted(map(tuple, df.select("k", "amount", "updated_at", "event_version", "order_date").collect()), key=repr)


def test_equals_the_plain_merge_over_several_batches(spark, table):
    _, _, t, s = sides(spark, 3)
    _, _, _, later = sides(spark, 4)
    table.replace(t)
    table.merge(s, wins())
    table.merge(later, wins())
    assert rows(table.read()) == rows(merged_with(merged_with(t, s), later))


def test_empty_sides_and_rows_without_a_key(spark, table):
    _, _, t, s = sides(spark, 5)
    table.replace(t.limit(0))
    table.merge(s, wins())
    table.merge(s.limit(0), wins())
    assert rows(table.read()) == rows(s)
    nameless = s.limit(1).withColumn("k", F.lit(None).cast("string"))
    table.merge(nameless, wins())
    assert table.read().filter("k IS NULL").count() == 1 and table.read().count() == s.count() + 1


@pytest.mark.parametrize("partitions", ["2", "8", "200"])
def test_only_the_batch_is_shuffled(spark, table, partitions):
    _, _, t, s = sides(spark, 6)
    table.replace(t)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.merge(s, wins())
        plan = table.merged(s, wins())._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "hashpartitioning(k" in plan and "Bucketed: true" in plan, plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # tasks write the bucket they joined: the table stays at a file per bucket
    assert len(table.read().inputFiles()) <= 4


def test_a_broken_merge_leaves_the_table_and_old_states_go(spark, table):
    _, _, t, s = sides(spark, 7)
    table.replace(t)
    broken = s.withColumn("amount", F.when(F.col("amount") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("amount")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        table.merge(broken, wins())
    assert rows(table.read()) == rows(t)
    for _ in range(3):
        table.merge(s, wins())
    assert rows(table.read()) == rows(merged_with(t, s))
    kept = [f for f in Path(table.folder).iterdir() if list(f.glob("*.parquet"))]
    assert len(table._states()) == 2 and len(kept) == 2
    with pytest.raises(ValueError, match="amount"):
        table.merge(s.drop("amount"), wins())


def test_names_are_checked_and_a_table_must_be_written_first(spark, tmp_path):
    with pytest.raises(ValueError):
        BucketedTable(spark, "a; drop", str(tmp_path), "k", 4)
    table = BucketedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path), "k", 4)
    assert not table.exists()
    with pytest.raises(LookupError):
        table.read()
