"""Headline timings, printed as one JSON line.

    BENCH_SF_DIR   folder of the test tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores                 (default *)

The raw events are made once and stored as Parquet and as JSON files before any
clock starts.  Each query runs until ten seconds or five runs are over, at least
twice, and the fastest run counts: the first ones mostly measure the JVM warming up.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from checks import queries as q  # noqa: E402
from tidemark.operators import contract, daily  # noqa: E402
from tidemark.plans import gold, silver  # noqa: E402
from tidemark.plans.lake import Lake, Settings  # noqa: E402
from tidemark.session import configure  # noqa: E402
from tidemark.spec import ORDER_EVENTS, Contract  # noqa: E402
from tidemark.streaming.ingest import ingest  # noqa: E402


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    work = Path(tempfile.mkdtemp(prefix="bench-"))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else str(os.cpu_count()))
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", str(work / "scratch"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    # -- inputs, not timed
    q.order_events(spark, sf_dir).repartition(16).write.parquet(str(work / "events"))
    events = spark.read.parquet(str(work / "events"))
    lines = events.select(F.to_json(F.struct(*ORDER_EVENTS.raw)).alias("value"))
    lines.repartition(100).write.text(str(work / "json"))
    strict, lenient = Contract.strict(), Contract()
    # a fixed time: a literal that changes makes Spark compile the same stage again
    now = q.at("2026-01-05 00:00:00")

    def validated(rules):
        return contract.validate(events, ORDER_EVENTS, rules)

    def clean(rules=strict):
        return contract.accepted(validated(rules), ORDER_EVENTS).select(*q.STATE)

    def day(n):
        return q.newest(clean().filter(F.col("ingest_timestamp") == q.at(q.DAYS[n - 1])))

    lakes = iter(range(1000))

    def new_lake(**changes) -> Lake:
        root = str(work / f"lake{next(lakes)}")
        base = {"slices": 16, "gold_slices": "month", "checkpoint": f"{root}/checkpoint"}
        return Lake(spark, Settings(root, **{**base, **changes}))

    def merge_three(**changes) -> Lake:
        lake = new_lake(**changes)
        for n in (1, 2, 3):
            silver.merge_batch(lake, lake.silver, day(n), n, q.at(q.AS_OF[n - 1]))
        return lake

    def whole_table_merge():
        state = day(1)
        for n in (2, 3):
            state = q.merge(state, day(n))
        consume(state)

    stored = merge_three(broadcast_bytes=0)
    state = stored.silver.read()
    dates = state.select("order_date").distinct()
    gold.recompute(stored)

    def gold_one_date():
        """One late order arrives; only its date is computed again."""
        late = stored.silver.read().limit(1).withColumn("event_version", F.col("event_version") + 1)
        silver.merge_batch(stored, stored.silver, late, as_of=now)
        start = time.time()
        gold.refresh(stored, now)
        return time.time() - start

    def ingest_files(**changes):
        ingest(new_lake(raw_dir=str(work / "json"), **changes), now)

    def stages():
        """Files to metrics, all stages."""
        lake = new_lake(raw_dir=str(work / "json"), layout="lines")
        for stage in (ingest, silver.process, gold.refresh):
            stage(lake, now)

    timed = {
        "validate_lenient": lambda: consume(clean(lenient)),
        "validate_strict": lambda: consume(clean()),
        "rejections_strict": lambda: consume(
            contract.rejections(contract.rejected(validated(strict)), ORDER_EVENTS, now)
        ),
        "quality_counters": lambda: contract.quality_counters(validated(strict)).first(),
        "latest_per_order": lambda: consume(q.newest(clean())),
        "daily_metrics": lambda: consume(daily.daily_metrics(q.newest(clean()), ORDER_EVENTS)),
        "silver_merge_whole_table": whole_table_merge,
        "silver_merge_sliced": lambda: merge_three(broadcast_bytes=0),
        "silver_merge_small_batch": lambda: merge_three(),
        "gold_refresh_one_date": gold_one_date,
        "gold_refresh_all_dates": lambda: consume(
            daily.refreshed_metrics(state, dates, ORDER_EVENTS, now)
        ),
        "gold_recompute": lambda: consume(daily.daily_metrics_with_mark(state, ORDER_EVENTS, now)),
        "affected_dates_exact": lambda: consume(
            daily.affected_dates(state, stored.gold.read(), ORDER_EVENTS, "exact")
        ),
        "ingest_100_files_json": lambda: ingest_files(mode="json", multi_line=False),
        "ingest_100_files_rescue": lambda: ingest_files(layout="lines"),
        "ingest_100_files_rescue_whole": lambda: ingest_files(layout="auto"),
        "all_stages": stages,
    }
    results = {}
    for name, query in timed.items():
        runs = []
        while len(runs) < 2 or (len(runs) < 5 and sum(runs) < 10):
            start = time.time()
            inner = query()
            runs.append(inner if isinstance(inner, float) else time.time() - start)
        results[name] = round(min(runs), 3)
        print(f"{name:32s}", *[f"{r:7.2f}" for r in runs], file=sys.stderr, flush=True)

    spark.stop()
    shutil.rmtree(work, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
