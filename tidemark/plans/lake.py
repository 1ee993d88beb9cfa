"""Where the tables of one pipeline live, and its options."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import optional_trusted_name, require_trusted_name
from tidemark.operators.audit import stage_alerts, stage_audit_rows
from tidemark.operators.daily import METRIC_STATE
from tidemark.operators.upsert import BROADCAST_BYTES, PREVIOUS_MARK, PREVIOUS_MEASURE
from tidemark.sources import tables
from tidemark.sources.tables import SlicedTable
from tidemark.spec import ORDER_EVENTS, Contract, Entity


@dataclass(frozen=True)
class Settings:
    """Everything a run can be told.  Table names have one to three parts."""

    root: str
    raw_dir: str = ""
    checkpoint: str = ""
    # Names and limits the tables and alerts of existing lakes have.
    bronze: str = "bronze_orders"
    silver: str = "silver_orders"
    gold: str = "gold_daily_metrics"
    quarantine: str = "quarantine_orders"
    stage_audit: str = ""
    upkeep_audit: str = ""

    # ingest: "json" or "rescue" (keeps whatever does not fit the schema); layout "split" takes arrays, single
    # objects and lines and reads them by ranges, "lines" only lines but in one pass, "auto" each file as a whole
    mode: str = "rescue"
    layout: str = "split"
    multi_line: bool = True

    # contract; unset requirements follow the production flag
    production: bool = False
    require_update_time: bool | None = None
    require_version: bool | None = None
    bad_update_time: str = "fallback"
    batch_order: str = "update_time"
    max_rescued: int = 100

    # silver reads "new" Bronze rows only, or "all" of them on every run
    read: str = "new"
    slices: int = 64
    # what a task of a merge holds of batch, table and result; the smaller of the two counts
    rows_per_task: int = 4_000_000
    bytes_per_task: int = 128 * 1024 * 1024
    broadcast_bytes: int = BROADCAST_BYTES

    # gold: how affected dates are found ("changes", "exact", "ingest"),
    # how the table is sliced ("date", "month")
    detect: str = "changes"
    gold_slices: str = "date"

    alert_on_anomaly: bool = True
    min_output_ratio: float = 0.1
    max_rejected: int = 1000

    retention_hours: int = 168
    replay_required: bool = True
    max_lag_hours: int = 24
    alert_on_upkeep_failure: bool = True

    @property
    def contract(self) -> Contract:
        def either(flag):
            return self.production if flag is None else flag

        return Contract(
            require_update_time=either(self.require_update_time),
            require_version=either(self.require_version),
            bad_update_time=self.bad_update_time,
            batch_order=self.batch_order,
        )

    @classmethod
    def local(cls, root: str, **changes) -> "Settings":
        base = cls(
            root,
            mode="json",
            quarantine="quarantine_orders_local",
            stage_audit="stage_audit_local",
            upkeep_audit="maintenance_audit_local",
        )
        return replace(base, **changes)

    @classmethod
    def for_production(cls, root: str, **changes) -> "Settings":
        base = cls(
            root,
            production=True,
            max_rescued=50,
            stage_audit="stage_audit",
            upkeep_audit="maintenance_audit",
        )
        return replace(base, **changes)


class Lake:
    """The tables of one entity under one root folder."""

    def __init__(self, spark: SparkSession, settings: Settings, entity: Entity = ORDER_EVENTS):
        self.spark, self.settings, self.entity = spark, settings, entity
        for role in ("bronze", "silver", "gold", "quarantine"):
            require_trusted_name(getattr(settings, role), f"{role}Table")
        optional_trusted_name(settings.stage_audit, "stageAuditTable")
        optional_trusted_name(settings.upkeep_audit, "maintenanceAuditTable")

    def path(self, name: str) -> str:
        return f"{self.settings.root.rstrip('/')}/{require_trusted_name(name, 'table').replace('.', '/')}"

    @property
    def bronze(self) -> SlicedTable:
        entity = self.entity
        return SlicedTable(self.spark, self.path(self.settings.bronze), entity.bronze_schema, None, "batch")

    @property
    def silver(self) -> SlicedTable:
        entity, count = self.entity, self.settings.slices
        return SlicedTable(
            self.spark,
            self.path(self.settings.silver),
            entity.state_schema,
            tables.hash_slice(entity.key, count),
            f"hash-{entity.key}-{count}",
            # lets a run that needs a few dates skip most of each file
            sort_by=(entity.date,),
            tracks_changes=True,
            hidden=f"{PREVIOUS_MEASURE} double, {PREVIOUS_MARK} timestamp",
        )

    @property
    def gold(self) -> SlicedTable:
        entity, by = self.entity, self.settings.gold_slices
        slice_of = {"date": tables.date_slice, "month": tables.month_slice}[by]
        return SlicedTable(
            self.spark, self.path(self.settings.gold), entity.daily_schema, slice_of(entity.date), by,
            hidden=METRIC_STATE, older_names={entity.date: entity.event_time},
        )

    def quarantine(self) -> DataFrame | None:
        return self._plain(self.settings.quarantine, drop=("_batch",))

    def stage_audit(self) -> DataFrame | None:
        return self._plain(self.settings.stage_audit)

    def upkeep_audit(self) -> DataFrame | None:
        return self._plain(self.settings.upkeep_audit)

    def _plain(self, name: str, drop: tuple[str, ...] = ()) -> DataFrame | None:
        if not name:
            return None
        try:
            return self.spark.read.parquet(self.path(name)).drop(*drop)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def register_views(self) -> None:
        """Temporary views with the tables' last name parts, for ad-hoc SQL."""
        found = {
            self.settings.bronze: self.bronze.read() if self.bronze.exists() else None,
            self.settings.silver: self.silver.read() if self.silver.exists() else None,
            self.settings.gold: self.gold.read() if self.gold.exists() else None,
            self.settings.quarantine: self.quarantine(),
            self.settings.stage_audit: self.stage_audit(),
            self.settings.upkeep_audit: self.upkeep_audit(),
        }
        for name, df in found.items():
            if df is not None:
                df.createOrReplaceTempView(name.split(".")[-1])

    def write_stage_audit(self, stage: str, counts: dict, run_id: str, as_of=None) -> DataFrame:
        """Store the audit row of a run and return the alerts it raises."""
        counted = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in counts.items()])
        rows = stage_audit_rows(counted, stage, run_id, as_of)
        if self.settings.stage_audit:
            tables.append(rows, self.path(self.settings.stage_audit))
        limit = self.settings.max_rejected if stage == "silver" else None
        judged = rows.withColumn("output_records", F.lit(counts["alert_output"]))
        alerts = stage_alerts(judged, self.settings.min_output_ratio, limit)
        return alerts if self.settings.alert_on_anomaly else alerts.filter("false")
