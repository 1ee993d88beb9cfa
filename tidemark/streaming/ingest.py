"""From files to the Bronze table, each file exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.shape import with_ingest_time
from tidemark.plans.lake import Lake
from tidemark.session import scratch
from tidemark.sources.json_files import json_stream, parse_with_rescue, rescue_stream
from tidemark.sources.json_ranges import read_records
from tidemark.streaming.progress import input_rows

UNKNOWN = -1


def open_stream(lake: Lake, **options) -> DataFrame:
    settings = lake.settings
    if settings.mode.strip().lower() == "json":
        return json_stream(lake.spark, settings.raw_dir, lake.entity, settings.multi_line, **options)
    return rescue_stream(lake.spark, settings.raw_dir, lake.entity, settings.layout, **options)


def ingest(
    lake: Lake,
    as_of: Column | None = None,
    then: Callable[[], object] | None = None,
    **options,
) -> DataFrame:
    """Append all files that are there and not read yet, then stop.

    The checkpoint remembers the files.  A batch that Spark repeats after a
    failure is recognised by its slice and not appended twice.  ``then`` runs
    after every batch, for a keyed table that follows without a second query.
    Returns the alerts of the run.

    The audit's input count is what the source gave: lines, blank ones too, or records.
    If the source gives files to be cut, it is the records cut from them, counted while they are written.
    """
    bronze, checkpoint = lake.bronze, lake.settings.checkpoint
    before = bronze.snapshot().version
    cut: list[int] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        name = f"{_query_id(lake, checkpoint)}-{batch_id}"
        known = bronze.versions().filter(F.col("slice") == name).limit(1).count()
        if not known:
            with scratch(lake.spark, "ranges") as folder:
                # nothing is shuffled between the records and the files, so a repeated task is not counted twice
                records = Observation("records")
                events = _events(lake, batch, folder, records)
                bronze.replace(with_ingest_time(events, lake.entity.mark, as_of), kind="append", into=name, as_of=as_of)
                if _gives_files(batch):
                    cut.append(records.get.get("records", 0))
        if then is not None:
            then()

    stream = open_stream(lake, **options)
    with input_rows(lake.spark) as counted:
        query = (
            stream.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        given = counted.of(query)
    received = UNKNOWN if given is None else given
    details = "input=rows"
    if _gives_files(stream):
        received, details = sum(cut), f"input=records,files={given}"

    added = (
        bronze.versions()
        .filter((F.col("version") > before) & (F.col("kind") == "append"))
        .agg(F.coalesce(F.sum("rows"), F.lit(0)))
        .first()[0]
    )
    counts = {
        "input_records": received,
        "output_records": added,
        "rejected_records": 0,
        "rescued_records": 0,
        "details": details,
        "alert_output": added,
    }
    return lake.write_stage_audit("bronze", counts, str(uuid.uuid4()), as_of)


def _gives_files(df: DataFrame) -> bool:
    return df.columns == ["path"]


def _events(lake: Lake, batch: DataFrame, folder: str, counted: Observation) -> DataFrame:
    if not _gives_files(batch):
        return batch
    # the file source has listed them on the driver already
    paths = [row["path"] for row in batch.collect()]
    records = read_records(lake.spark, paths, folder).observe(counted, F.count(F.lit(1)).alias("records"))
    return parse_with_rescue(records, lake.entity)


def _query_id(lake: Lake, checkpoint: str) -> str:
    """Identity of the checkpoint: a new one counts its batches from zero again."""
    return lake.spark.read.json(f"{checkpoint}/metadata").first()["id"]
