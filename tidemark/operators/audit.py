"""Audit rows, alerts and upkeep policy as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.failures import is_permission_failure
from tidemark.functions.names import untrusted_name_message

# The columns of the two audit tables.
STAGE_AUDIT = (
    "stage_run_id string, run_timestamp timestamp, stage_name string, input_records bigint, "
    "output_records bigint, rejected_records bigint, rescued_records bigint, status string, "
    "details string"
)
UPKEEP_AUDIT = (
    "maintenance_run_id string, run_timestamp timestamp, table_name string, status string, "
    "permission_failure boolean, retention_policy_risk boolean, vacuum_retention_hours int, "
    "audit_replay_required boolean, slow_downstream_max_lag_hours int, error_class string, "
    "error_message string"
)
# Fixed value: hours of history that replaying an audit needs.
REPLAY_HOURS = 168
# Fixed value: error class recorded for a refused table name.
BAD_NAME_CLASS = "IllegalArgumentException"


def stage_audit_rows(
    counts: DataFrame,
    stage: str,
    run_id: str | Column,
    as_of: Column | None = None,
    status: str = "SUCCESS",
) -> DataFrame:
    """Audit rows from a DataFrame of counts.

    ``counts`` carries input_records, output_records, rejected_records,
    rescued_records and details.  A stage gives its one row of counts, which it needs itself.
    """
    return counts.select(
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("stage_run_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_timestamp"),
        F.lit(stage).alias("stage_name"),
        *[
            F.col(c).cast("bigint").alias(c)
            for c in ("input_records", "output_records", "rejected_records", "rescued_records")
        ],
        F.lit(status).alias("status"),
        F.col("details").cast("string").alias("details"),
    )


def stage_alerts(
    audit: DataFrame,
    min_output_ratio: float = 0.1,
    max_rejected: int | None = 1000,
    output: str = "output_records",
) -> DataFrame:
    """One row per audit row and alert it raises.

    A negative input count means unknown and raises no ratio alert.
    """
    received, produced = F.col("input_records"), F.col(output)
    found = [
        F.when((received > 0) & (produced == 0), F.lit("ZERO_OUTPUT")),
        F.when(
            (received > 0) & (produced > 0) & (produced / received < F.lit(min_output_ratio)),
            F.lit("LOW_OUTPUT_RATIO"),
        ),
    ]
    if max_rejected is not None:
        found.append(F.when(F.col("rejected_records") > max_rejected, F.lit("TOO_MANY_REJECTED")))
    alerts = F.array_compact(F.array(*found))
    return audit.withColumn("alert", F.explode(alerts))


def audit_report(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("run_timestamp"), "stage_name").select(
        "stage_name",
        "input_records",
        "output_records",
        "rejected_records",
        "rescued_records",
        "status",
        "details",
    )


def retention_at_risk(hours: Column, replay_required: Column, max_lag_hours: Column) -> Column:
    """History is dropped before the slowest reader is done with it."""
    needed = F.greatest(F.when(replay_required, F.lit(REPLAY_HOURS)).otherwise(F.lit(0)), max_lag_hours)
    return hours < needed


def upkeep_audit_rows(
    targets: DataFrame,
    known_tables: DataFrame,
    failures: DataFrame,
    run_id: str,
    hours: int = REPLAY_HOURS,
    replay_required: bool = True,
    max_lag_hours: int = 24,
    as_of: Column | None = None,
) -> DataFrame:
    """Outcome per target table.

    ``targets(table_name)``, ``known_tables(table_name)`` and
    ``failures(table_name, error_class, error_message)``.
    """
    refused = untrusted_name_message(F.col("table_name"), "maintenanceTable")
    checked = targets.select("table_name", F.trim("table_name").alias("_name"), refused.alias("_refused"))
    known = known_tables.select(F.col("table_name").alias("_name")).distinct().withColumn("_known", F.lit(True))
    failed = failures.select(
        F.col("table_name").alias("_name"),
        F.col("error_class").alias("_class"),
        F.col("error_message").alias("_message"),
        F.lit(True).alias("_failed"),
    )
    joined = checked.join(known, "_name", "left").join(failed, "_name", "left")

    bad_name, broke, missing = (
        F.col("_refused").isNotNull(),
        F.col("_failed").isNotNull(),
        F.col("_known").isNull(),
    )
    replay, lag, kept = F.lit(replay_required), F.lit(max_lag_hours), F.lit(hours)
    return joined.select(
        F.lit(run_id).alias("maintenance_run_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_timestamp"),
        F.when(bad_name, F.col("table_name")).otherwise(F.col("_name")).alias("table_name"),
        F.when(bad_name | broke, F.lit("FAILED"))
        .when(missing, F.lit("SKIPPED"))
        .otherwise(F.lit("SUCCESS"))
        .alias("status"),
        (~bad_name & broke & is_permission_failure(F.col("_message"))).alias("permission_failure"),
        retention_at_risk(kept, replay, lag).alias("retention_policy_risk"),
        kept.cast("int").alias("vacuum_retention_hours"),
        replay.alias("audit_replay_required"),
        lag.cast("int").alias("slow_downstream_max_lag_hours"),
        F.when(bad_name, F.lit(BAD_NAME_CLASS)).when(broke, F.col("_class")).alias("error_class"),
        F.when(bad_name, F.col("_refused"))
        .when(broke, F.col("_message"))
        .when(missing, F.lit("Table does not exist"))
        .alias("error_message"),
    )


def upkeep_summary(audit: DataFrame) -> DataFrame:
    status = F.col("status")
    return audit.groupBy("maintenance_run_id").agg(
        F.count_if(status == "SUCCESS").alias("succeeded"),
        F.count_if(status == "SKIPPED").alias("skipped"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(F.col("permission_failure")).alias("permission_failures"),
    )


def upkeep_alerts(audit: DataFrame) -> DataFrame:
    """Alerts of an upkeep run: retention too short, failures, missing rights."""
    raised = audit.groupBy("maintenance_run_id").agg(
        F.bool_or("retention_policy_risk").alias("risk"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("permission_failure")).alias("permission_failures"),
    )
    alerts = F.array_compact(
        F.array(
            F.when(F.col("risk"), F.lit("RETENTION_RISK")),
            F.when(F.col("failed") > 0, F.lit("UPKEEP_FAILURES")),
            F.when(F.col("permission_failures") > 0, F.lit("PERMISSION_PROBLEM")),
        )
    )
    return raised.select("maintenance_run_id", "failed", "permission_failures", F.explode(alerts).alias("alert"))
