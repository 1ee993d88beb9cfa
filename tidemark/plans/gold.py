"""The keyed table to daily metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.daily import (
    affected_dates,
    changes_by_date,
    daily_metrics_with_state,
    date_ranges,
    in_ranges,
    maintained_metrics,
    refreshed_metrics,
)
from tidemark.operators.upsert import PREVIOUS_DATE, PREVIOUS_MARK, PREVIOUS_MEASURE, CHANGE, UPDATED
from tidemark.plans.lake import Lake
from tidemark.session import scratch
from tidemark.sources.tables import HistoryExpired, Snapshot


def find_affected(lake: Lake, state: DataFrame, made: Snapshot) -> DataFrame:
    """Dates to compute again.

    ``changes`` asks the keyed table what its merges touched since the metrics
    were made; without metrics or that history it compares both tables.
    """
    entity, detect = lake.entity, lake.settings.detect
    if not made.version:
        return affected_dates(state, None, entity)
    if detect == "changes":
        try:
            return lake.silver.changed_dates(entity.date, made.source_version)
        except HistoryExpired:
            detect = "exact"
    metrics = lake.gold.read(snapshot=made)
    if not metrics.filter(F.col(entity.mark_as).isNotNull()).limit(1).count():
        metrics = None  # metrics from before marks were kept
    return affected_dates(state, metrics, entity, detect)


def refresh(lake: Lake, as_of: Column | None = None) -> DataFrame | None:
    """Bring the affected dates up to date.  Returns the alerts, or None if there were none to do.

    Where the keyed table says what changed, the changes are added to the stored metrics and taken from them;
    only dates that this cannot settle are computed again from their rows.
    """
    entity = lake.entity
    silver, gold, date = lake.silver, lake.gold, entity.date
    source, made = silver.snapshot(), gold.snapshot()
    state = silver.read(snapshot=source)
    done = _maintain(lake, made, source, as_of)
    if done is not None:
        return done

    # written out: the dates are needed several times, and their size is then known
    with scratch(lake.spark, "dates") as folder:
        find_affected(lake, state, made).write.parquet(folder)
        dates = lake.spark.read.schema(f"`{date}` date").parquet(folder)
        span = dates.agg(
            F.count(F.lit(1)).alias("n"),
            F.count(date).alias("known"),
            F.collect_set(gold.slice_of).alias("slices"),
        ).first()
        if span["n"] == 0:
            if made.source_version < source.version:
                gold.mark_processed(source.version, as_of)
            return None

        # the keyed table is sorted by date within each file: this skips row groups, also between far dates
        if span["n"] == span["known"]:
            state = state.filter(in_ranges(F.col(date), date_ranges(dates, date)))
        fresh = refreshed_metrics(state, dates, entity, as_of)

        return _replace_dates(lake, dates, fresh, span["n"], span["slices"], made, source, as_of)


def _replace_dates(
    lake: Lake, dates: DataFrame, fresh: DataFrame, count: int, slices: list[str], made: Snapshot, source: Snapshot, as_of: Column | None
) -> DataFrame:
    """Store the new metrics of ``dates``, which ``fresh`` has unless nothing is left of them."""
    gold, entity, date = lake.gold, lake.entity, lake.entity.date
    affected = dates.select(F.col(date).alias("of"))
    old = gold.read(slices, snapshot=made, with_hidden=True).join(affected, F.col(date).eqNullSafe(F.col("of")), "left_anti")
    counted = Observation("dates")
    # null rows apart, the fresh ones are those of this run
    rows = old.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)), allowMissingColumns=True)
    rows = gold.with_slice(rows).repartition("_slice").observe(
        counted, F.count_if(F.col("_fresh")).alias("dates"),
        F.coalesce(F.sum(F.when(F.col("_fresh"), F.col(entity.count_as))), F.lit(0)).alias("rows"))
    gold.replace(rows.drop("_fresh"), slices, as_of=as_of, source_version=source.version, snapshot=made)
    done = counted.get
    counts = {
        "input_records": done["rows"],
        "output_records": done["dates"],
        "rejected_records": 0,
        "rescued_records": 0,
        "details": f"affectedDates={count}",
        "alert_output": done["dates"],
    }
    return lake.write_stage_audit("gold", counts, str(uuid.uuid4()), as_of)


def _maintain(lake: Lake, made: Snapshot, source: Snapshot, as_of: Column | None) -> DataFrame | None:
    """Add the changes since the metrics were made to them; None where that is not known."""
    entity, gold, date = lake.entity, lake.gold, lake.entity.date
    if lake.settings.detect != "changes" or not made.version or made.source_version >= source.version:
        return None
    try:
        changed = lake.silver.changes_since(made.source_version)
    except HistoryExpired:
        return None
    # rows merged before their earlier values were kept
    lost = (F.col(CHANGE) == UPDATED) & F.col(PREVIOUS_DATE).isNotNull() & F.col(PREVIOUS_MEASURE).isNull()
    before = {"date": PREVIOUS_DATE, "measure": PREVIOUS_MEASURE, "mark": PREVIOUS_MARK}
    with scratch(lake.spark, "changes") as folder:
        counted = Observation("changes")
        columns = [entity.key, date, entity.measure, entity.mark, *before.values()]
        changed = changed.observe(counted, F.count_if(lost).alias("lost"), F.count(F.lit(1)).alias("rows")).select(*columns)
        binned = changes_by_date(changed, entity, before)
        binned.write.parquet(f"{folder}/binned")
        if counted.get["lost"]:
            return None
        binned = lake.spark.read.schema(binned.schema).parquet(f"{folder}/binned")
        span = binned.agg(F.count_distinct(F.coalesce(date, F.lit("0001-01-01").cast("date"))).alias("n"), F.collect_set(gold.slice_of).alias("slices")).first()
        if not span["n"]:
            return None
        if not gold.read(snapshot=made).filter(F.col(entity.mark_as).isNotNull()).limit(1).count():
            return None  # metrics from before marks were kept: every date is affected
        old = gold.read(span["slices"], snapshot=made, with_hidden=True)
        fresh, again = maintained_metrics(old, binned, entity, as_of)
        again.write.parquet(f"{folder}/again")
        again = lake.spark.read.schema(f"`{date}` date").parquet(f"{folder}/again")
        unsettled = again.agg(F.count(F.lit(1)).alias("n"), F.count(date).alias("known"), F.min(date).alias("first"), F.max(date).alias("last")).first()
        if unsettled["n"]:
            state = lake.silver.read(snapshot=source)
            if unsettled["n"] == unsettled["known"]:
                state = state.filter(F.col(date).between(unsettled["first"], unsettled["last"]))
            fresh = fresh.unionByName(refreshed_metrics(state, again, entity, as_of))
        dates = binned.select(date).distinct()
        return _replace_dates(lake, dates, fresh, span["n"], span["slices"], made, source, as_of)


def recompute(lake: Lake, as_of: Column | None = None) -> int:
    """All dates from the whole keyed table, replacing everything."""
    gold, source, made = lake.gold, lake.silver.snapshot(), lake.gold.snapshot()
    state = lake.silver.read(snapshot=source)
    rows = daily_metrics_with_state(state, lake.entity, as_of)
    return gold.replace(
        gold.with_slice(rows).repartition("_slice"),
        made.slices,
        as_of=as_of,
        source_version=source.version,
        snapshot=made,
    )
