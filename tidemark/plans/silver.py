"""Bronze to the keyed table."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.contract import accepted, quality_counts, rejected, rejections, validate
from tidemark.operators.latest import latest_per_key
from tidemark.operators.shape import evolve_state
from tidemark.operators.upsert import (
    PREVIOUS_MARK,
    PREVIOUS_MEASURE,
    all_inserted,
    merge_newer,
    row_bytes,
    supersedes,
)
from tidemark.plans.lake import Lake
from tidemark.session import scratch
from tidemark.sources.places import PLACE, deal, to_places
from tidemark.sources.tables import HistoryExpired, SlicedTable, change_counts


_NOTHING = {
    "input_records": 0,
    "output_records": 0,
    "rejected_records": 0,
    "rescued_records": 0,
    "details": "cleanRecords=0,quarantineRows=0",
    "alert_output": 0,
}


class TooManyRescued(RuntimeError):
    """More unreadable records than the settings allow in production."""


def process(lake: Lake, as_of: Column | None = None) -> DataFrame:
    """One run over new (or all) Bronze rows.  Returns the alerts it raises.

    The batch is read and checked once and counted in that pass; quarantine and merge start
    from what it wrote to the shared scratch folder.
    """
    bronze, seen = lake.bronze, lake.silver.snapshot().source_version
    arrived = bronze.snapshot()
    if lake.settings.read == "all":
        events, run_id = bronze.read(snapshot=arrived), str(uuid.uuid4())
    elif seen < arrived.version:
        # a repeated run covers the same rows and replaces its own quarantine
        run_id = f"after-{seen}"
        try:
            events = bronze.written_since(seen, "append").drop("_version", "_slice")
        except HistoryExpired:
            # single appends are gone, but all their rows are in what they were folded into
            events = bronze.read(snapshot=arrived)
    else:
        return lake.write_stage_audit("silver", _NOTHING, str(uuid.uuid4()), as_of)
    return process_events(lake, events, run_id, arrived.version, as_of)


def process_events(
    lake: Lake, events: DataFrame, run_id: str, source_version: int, as_of: Column | None = None
) -> DataFrame:
    checked = validate(events, lake.entity, lake.settings.contract)
    with scratch(lake.spark, "checked") as folder:
        counted = Observation("checked")
        checked.observe(counted, *quality_counts()).write.parquet(folder)
        validated = lake.spark.read.schema(checked.schema).parquet(folder)
        return _store(lake, validated, counted.get, run_id, source_version, as_of)


def _store(
    lake: Lake, validated: DataFrame, counts: dict, run_id: str, source_version: int, as_of: Column | None
) -> DataFrame:
    """Quarantine, merge and audit of checked events."""
    settings, entity = lake.settings, lake.entity

    if counts["bad_records"]:
        # few rows out of very many tasks: gather them into files of a sensible size
        rows = rejections(rejected(validated), entity, as_of).hint("rebalance")
        rows.write.mode("overwrite").parquet(f"{lake.path(settings.quarantine)}/_batch={run_id}")
    if settings.production and counts["rescued_records"] > settings.max_rescued:
        raise TooManyRescued(
            f"{counts['rescued_records']} records could not be read in full, more than the {settings.max_rescued} "
            "allowed; they are in quarantine and nothing was merged"
        )

    silver, inserted, details = lake.silver, 0, ""
    if counts["clean_records"]:
        newest = latest_per_key(
            accepted(validated, entity), entity.key, entity.newest_first(settings.contract), any_splits=True
        )
        counted = Observation("merged")
        merge_batch(lake, silver, newest, source_version, as_of, counted)
        changes = counted.get
        inserted = changes["inserted"]
        details = f",inserted={inserted},updated={changes['updated']}"
    else:
        silver.mark_processed(source_version, as_of)

    audit = {
        "input_records": counts["total_records"],
        "output_records": inserted,
        "rejected_records": counts["bad_records"],
        "rescued_records": counts["rescued_records"],
        "details": (
            f"cleanRecords={counts['clean_records']},quarantineRows={counts['quarantine_rows']}{details}"
        ),
        "alert_output": counts["clean_records"],
    }
    return lake.write_stage_audit("silver", audit, run_id, as_of)


def merge_batch(
    lake: Lake,
    silver: SlicedTable,
    newest: DataFrame,
    source_version: int | None = None,
    as_of: Column | None = None,
    counted: Observation | None = None,
) -> int:
    """Merge one row per key into the table, reading and writing only its slices.

    The batch is first written to the shared scratch folder.  That gives its
    exact size and slices for the decisions below, and a lost executor does not
    cause the events to be checked again.  ``counted`` gets what the merge inserted, updated and left.
    """
    settings, entity = lake.settings, lake.entity
    columns = StructType.fromDDL(entity.state_schema).names
    with scratch(lake.spark, "batch") as folder:
        silver.with_slice(newest.select(*columns)).write.parquet(folder)
        batch = lake.spark.read.schema(f"{entity.state_schema}, _slice string").parquet(folder)
        sizes = (
            batch.groupBy("_slice")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(batch)).alias("bytes"))
            .collect()
        )
        touched = [r["_slice"] for r in sizes]
        now = silver.snapshot()
        old = {s: now.slices[s] for s in touched if s in now.slices}
        # batch, table and result are sorted in one task: their rows together are what it holds
        rows = {r["_slice"]: 2 * (r["rows"] + (old[r["_slice"]].rows if r["_slice"] in old else 0)) for r in sizes}
        # the table's rows are taken to be as wide as those of the batch
        width = sum(r["bytes"] for r in sizes) / max(1, sum(r["rows"] for r in sizes))
        most = min(settings.rows_per_task, max(1, int(settings.bytes_per_task / max(1, width))))
        tasks = max(lake.spark.sparkContext.defaultParallelism, math.ceil(2 * sum(rows.values()) / most))
        places = deal(rows, most, tasks)

        def spread(df: DataFrame) -> DataFrame:
            return to_places(df, places, entity.key)

        track = {PREVIOUS_MEASURE: entity.measure, PREVIOUS_MARK: entity.mark}
        if not old:
            merged = all_inserted(spread(batch), entity.date, track)
        else:
            # a table from before versions were kept: its rows count as updated when they happened
            target = evolve_state(
                silver.read(old, with_slice=True, snapshot=now),
                entity.updated_as, entity.version_as, entity.event_time, entity.mark,
            )
            small = sum(r["bytes"] for r in sizes) <= settings.broadcast_bytes
            if small:
                batch = batch.repartition("_slice")
            else:
                target, batch = spread(target), spread(batch)
            merged = merge_newer(
                target,
                batch,
                entity.key,
                supersedes(entity.version_as, entity.updated_as),
                cluster_by=["_slice"] if small else ["_slice", PLACE],
                track_date=entity.date,
                source_is_small=small,
                track=track,
            )
        # nothing is shuffled between here and the files, so a repeated task is not counted twice
        merged = merged.observe(counted, *change_counts()) if counted is not None else merged
        return silver.replace(
            merged.drop(PLACE), as_of=as_of, source_version=source_version, snapshot=now
        )
