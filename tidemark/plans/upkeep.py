"""Compaction and retention for the tables of a lake."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import is_trusted_name
from tidemark.operators.audit import upkeep_alerts, upkeep_audit_rows
from tidemark.plans.lake import Lake
from tidemark.sources import tables
from tidemark.sources.upkeep import FILE_BYTES, compact_slices, delete_expired, fold_plain, fold_slices

_LOG = logging.getLogger(__name__)

# files of a versions table after which they are rewritten into one
VERSION_FILES = 200


def run(
    lake: Lake,
    *names: str,
    file_bytes: int = FILE_BYTES,
    as_of: Column | None = None,
) -> DataFrame:
    """Upkeep of the named tables, by default all of the lake.  Returns the audit rows.

    A table that fails does not keep the others from being looked after.  Its alerts, at most one of a
    kind, are logged as warnings where the settings ask for it.
    """
    settings, spark = lake.settings, lake.spark
    as_of = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of
    known = {settings.bronze: lake.bronze, settings.silver: lake.silver, settings.gold: lake.gold}
    plain = (settings.quarantine, settings.stage_audit, settings.upkeep_audit)
    # by default: the three tables of every lake, and of the others those that have been made
    names = names or (*known, *(n for n in plain if n and tables.exists(spark, lake.path(n))))
    targets = spark.createDataFrame([(n,) for n in names], "table_name string")
    usable = targets.filter(is_trusted_name(F.col("table_name"))).select(F.trim("table_name"))

    present, failures = [], []
    for (name,) in usable.collect():
        try:
            table = known.get(name)
            if table is None:
                path = lake.path(name)
                if tables.exists(spark, path):
                    present.append((name,))
                    fold_plain(spark, path, file_bytes, "_batch" if name == settings.quarantine else None)
                continue
            if not table.exists():
                continue
            present.append((name,))
            fold = fold_slices if name == settings.bronze else compact_slices
            fold(table, file_bytes, as_of)
            delete_expired(table, settings.retention_hours, as_of)
            table.fold_versions(above=VERSION_FILES)
        except Exception as error:  # noqa: BLE001 - every failure belongs into the audit
            failures.append((name, type(error).__name__, str(error)))

    audit = upkeep_audit_rows(
        targets,
        spark.createDataFrame(present, "table_name string"),
        spark.createDataFrame(failures, "table_name string, error_class string, error_message string"),
        str(uuid.uuid4()),
        settings.retention_hours,
        settings.replay_required,
        settings.max_lag_hours,
        as_of,
    )
    if settings.upkeep_audit:
        tables.append(audit.coalesce(1), lake.path(settings.upkeep_audit))
    if settings.alert_on_upkeep_failure:
        for alert in upkeep_alerts(audit).collect():
            _LOG.warning("table upkeep: %s", alert.asDict())
    return audit
