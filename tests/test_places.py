"""Slices dealt to tasks by their size."""

import random

from pyspark.sql import functions as F

from tests.test_pipeline import lake_at
from tidemark.plans.silver import merge_batch
from tidemark.sources.places import PLACE, deal, to_places


def loads(rows, places):
    found = {}
    for name, tasks in places.items():
        for task in tasks:
            found[task] = found.get(task, 0) + rows[name] / len(tasks)
    return found


def test_no_task_holds_much_more_than_another():
    pick = random.Random(1)
    rows = {str(n): pick.randrange(1, 1000) for n in range(300)} | {"large": 50_000}
    places = deal(rows, 2_000, 120)
    assert len(places["large"]) == 25 and all(len(p) == 1 for name, p in places.items() if name != "large")
    assert max(loads(rows, places).values()) <= 2_200
    # equal slices and as many tasks: one each, whatever their names hash to
    assert sorted(loads(dict.fromkeys("abcdefgh", 5), deal(dict.fromkeys("abcdefgh", 5), 10, 8)).values()) == [5] * 8


def test_rows_go_where_they_are_dealt(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 4).cast("string").alias("_slice"))
    found = to_places(rows, deal(dict.fromkeys("0123", 1000), 500, 8), "k").groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(PLACE).alias("places"), F.count_distinct("_slice").alias("slices")).collect()
    assert len(found) == 8 and all((r["places"], r["slices"]) == (1, 1) and 400 < r["n"] < 600 for r in found)


def test_a_merge_holds_few_rows_in_a_task(spark, tmp_path):
    """Eight slices and eight tasks: hashes put two or three slices into one task."""
    lake = lake_at(spark, tmp_path, slices=8, broadcast_bytes=0, rows_per_task=1600)

    def batch(amount, version):
        when = F.timestamp_seconds(F.lit(1_767_225_600) + version)
        return spark.range(3200).select(
            F.concat(F.lit("o"), "id").alias("orderId"), F.lit("c").alias("customerId"), F.lit(amount).alias("amount"),
            when.alias("timestamp"), when.alias("ingest_timestamp"), when.alias("updated_at"),
            F.lit(version).cast("bigint").alias("event_version"), F.to_date(when).alias("order_date"))

    # a task writes a file for each slice that it holds: its rows of a version are those of its files
    def rows_of_tasks(version):
        name = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task")
        files = spark.read.parquet(lake.silver.folder(version)).groupBy(name)
        return [r["count"] for r in files.count().collect()]

    assert sum(found := rows_of_tasks(merge_batch(lake, lake.silver, batch(1.0, 1)))) == 3200 and max(found) <= 800
    # a batch as large as the table: each task holds both and the result
    assert sum(found := rows_of_tasks(merge_batch(lake, lake.silver, batch(2.0, 2)))) == 3200 and max(found) <= 500
    assert lake.silver.read().filter("amount = 2.0 AND event_version = 2").count() == 3200


def test_a_merge_holds_few_bytes_in_a_task(spark, tmp_path):
    """Slices well below the limit of rows are spread by the width of their rows."""
    lake = lake_at(spark, tmp_path, slices=2, broadcast_bytes=0, bytes_per_task=200_000)

    def batch(amount, version):
        when = F.timestamp_seconds(F.lit(1_767_225_600) + version)
        return spark.range(2000).select(
            F.concat(F.lit("o"), "id").alias("orderId"), F.lit("c" * 800).alias("customerId"), F.lit(amount).alias("amount"),
            when.alias("timestamp"), when.alias("ingest_timestamp"), when.alias("updated_at"),
            F.lit(version).cast("bigint").alias("event_version"), F.to_date(when).alias("order_date"))

    for version, most in ((1, 160), (2, 80)):
        merged = merge_batch(lake, lake.silver, batch(float(version), version))
        task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task")
        found = [r["count"] for r in spark.read.parquet(lake.silver.folder(merged)).groupBy(task).count().collect()]
        assert sum(found) == 2000 and max(found) <= most, (version, sorted(found))
    assert lake.silver.read().filter("amount = 2.0 AND length(customerId) = 800").count() == 2000
