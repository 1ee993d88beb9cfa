"""One query per operator, over the whole test tables.

Timestamps leave as zone-less ones, which is how DuckDB reads the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.inputs import order_events
from tidemark.functions.failures import is_permission_failure
from tidemark.functions.names import is_trusted_name
from tidemark.operators import audit, contract, daily, reports, shape, upsert
from tidemark.operators.latest import latest_per_key
from tidemark.plans import gold, silver
from tidemark.plans.lake import Lake, Settings
from tidemark.plans.pipeline import follow
from tidemark.session import configure, forget_later, keep, scratch_dir
from tidemark.sources import tables
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.tables import expired
from tidemark.sources.upkeep import compact_slices
from tidemark.spec import CATEGORY, CORRUPT, ORDER_EVENTS, REASON, RESCUED, VIOLATIONS, Contract, Entity
from tidemark.streaming.ingest import ingest
from tidemark.streaming.newest import merge_newest

STRICT, LENIENT = Contract.strict(), Contract()
DAYS = ("2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00")
AS_OF = ("2026-01-01 01:00:00", "2026-01-02 01:00:00", "2026-01-03 01:00:00")
STATE = [
    "orderId", "customerId", "amount", "timestamp", "ingest_timestamp", "updated_at",
    "event_version", "order_date",
]
LOOKUP = ["orderId", "customerId", "amount", "order_date", "updated_at", "event_version"]

CLICKS = Entity(
    name="clicks",
    raw={"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "value": "double"},
    key="event_id",
    event_time="ts",
    update_time="ts",
    version="event_id",
    measure="value",
    date="event_date",
    updated_as="ts",
    version_as="event_id",
    trimmed=(),
    blank_as_null=(),
    formats=(),
    rules=(),
    count_as="events",
    sum_as="total_value",
    mark="ts",
)


def at(text: str):
    return F.lit(text).cast("timestamp")


def zoneless(df: DataFrame) -> DataFrame:
    times = {n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(times) if times else df


def validated(spark, sf, rules=STRICT) -> DataFrame:
    return contract.validate(order_events(spark, sf), ORDER_EVENTS, rules)


def with_error_text(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", F.array_join(VIOLATIONS, ","))


def clean(spark, sf, rules=STRICT) -> DataFrame:
    return contract.accepted(validated(spark, sf, rules), ORDER_EVENTS).select(*STATE)


def newest(df: DataFrame, rules=STRICT) -> DataFrame:
    return latest_per_key(df, "orderId", ORDER_EVENTS.newest_first(rules), any_splits=True)


def latest(spark, sf) -> DataFrame:
    return newest(clean(spark, sf))


def batch(spark, sf, day: int) -> DataFrame:
    return newest(clean(spark, sf).filter(F.col("ingest_timestamp") == at(DAYS[day - 1])))


def so_far(spark, sf, day: int) -> DataFrame:
    return newest(clean(spark, sf).filter(F.col("ingest_timestamp") <= at(DAYS[day - 1])))


def merge(target: DataFrame, source: DataFrame, **options) -> DataFrame:
    wins = upsert.supersedes("event_version", "updated_at")
    return upsert.merge_newer(target, source, "orderId", wins, **options)


def silver_after(spark, sf, day: int) -> DataFrame:
    state = batch(spark, sf, 1)
    for n in range(2, day + 1):
        state = merge(state, batch(spark, sf, n))
    return state


def silver_bucketed(spark, sf) -> DataFrame:
    """The same merges into a table that lies in buckets of its key."""
    valid = keep(clean(spark, sf), "clean")
    of_day = lambda n: newest(valid.filter(F.col("ingest_timestamp") == at(DAYS[n - 1])))
    folder = forget_later(spark, scratch_dir(spark, "bucketed"))
    table = BucketedTable(spark, f"silver_{uuid.uuid4().hex}", folder, "orderId", buckets=64)
    table.replace(of_day(1))
    for n in (2, 3):
        table.merge(of_day(n), upsert.supersedes("event_version", "updated_at"))
    return table.read().select(*STATE)


def silver_small_batches(spark, sf) -> DataFrame:
    """The same merges, looking each batch up in place as long as it is small enough."""
    valid = keep(clean(spark, sf), "clean")
    state = None
    for moment in DAYS:
        arrived = keep(newest(valid.filter(F.col("ingest_timestamp") == at(moment))), "batch")
        small = upsert.fits_broadcast(arrived)
        merged = arrived if state is None else merge(state, arrived, source_is_small=small)
        state = keep(merged.select(*STATE), "state")
    return state


def silver_states(spark, sf, days: int) -> list[DataFrame]:
    """The table after each day.  Like a real run, each day starts from written files."""
    valid = keep(clean(spark, sf), "clean")
    states = []
    for n in range(1, days + 1):
        arrived = newest(valid.filter(F.col("ingest_timestamp") == at(DAYS[n - 1])))
        state = merge(states[-1], arrived) if states else arrived
        states.append(keep(state.select(*STATE), "state"))
    return states


def silver_cumulative(spark, sf) -> DataFrame:
    state = batch(spark, sf, 1)
    for n in (2, 3):
        state = merge(state, so_far(spark, sf, n))
    return state.select(*STATE)


def silver_changes(spark, sf) -> DataFrame:
    merged = merge(silver_after(spark, sf, 2), batch(spark, sf, 3), track_date="order_date")
    return merged.filter(F.col(upsert.CHANGE).isNotNull()).select(
        "orderId",
        F.col(upsert.CHANGE).alias("change"),
        "order_date",
        F.col(upsert.PREVIOUS_DATE).alias("previous_date"),
    )


def silver_evolved(spark, sf) -> DataFrame:
    state = batch(spark, sf, 1).drop("updated_at", "event_version")
    for n in (2, 3):
        state = shape.evolve_state(state, "updated_at", "event_version", "timestamp", "ingest_timestamp")
        state = merge(state.select(*STATE), batch(spark, sf, n))
    return state.select(*STATE)


def quarantine(spark, sf) -> DataFrame:
    rows = contract.rejections(contract.rejected(validated(spark, sf)), ORDER_EVENTS)
    return rows.drop("quarantined_at")


def gold_of(state: DataFrame, run: int) -> DataFrame:
    return daily.daily_metrics_with_mark(state, ORDER_EVENTS, at(AS_OF[run - 1]))


def gold_after(spark, sf, day: int, detect: str = "ingest") -> DataFrame:
    metrics = None
    for n, state in enumerate(silver_states(spark, sf, day), start=1):
        dates = daily.affected_dates(state, metrics, ORDER_EVENTS, detect)
        metrics = keep(
            daily.refresh(
                metrics, state, dates, ORDER_EVENTS, detect != "ingest", at(AS_OF[n - 1])
            ),
            "metrics",
        )
    return metrics


def dates_of_third_day(spark, sf, detect: str = "ingest", without: str = "") -> DataFrame:
    _, before, now = silver_states(spark, sf, 3)
    return daily.affected_dates(now, gold_of(before, 2).drop(without), ORDER_EVENTS, detect)


def silver_on_affected_dates(spark, sf) -> DataFrame:
    _, before, now = silver_states(spark, sf, 3)
    dates = daily.affected_dates(now, gold_of(before, 2), ORDER_EVENTS)
    return daily.restrict_to_dates(now, dates, ORDER_EVENTS).select(*STATE)


def gold_legacy(spark, sf) -> DataFrame:
    _, before, now = silver_states(spark, sf, 3)
    old = gold_of(before, 2)
    dates = daily.affected_dates(now, old, ORDER_EVENTS)
    fresh = daily.refreshed_metrics(now, dates, ORDER_EVENTS, at(AS_OF[2]))
    legacy = old.withColumnRenamed("order_date", "timestamp").drop("gold_updated_at")
    return upsert.replace_by_legacy_key(legacy, fresh, "order_date", "timestamp")


def gold_view(spark, sf) -> DataFrame:
    return daily.daily_view(spark, silver_after(spark, sf, 3), ORDER_EVENTS).drop("gold_updated_at")


def counts_of_tables(spark, sf) -> DataFrame:
    state = latest(spark, sf)
    return reports.table_counts(
        {
            "bronze": order_events(spark, sf),
            "silver": state,
            "gold": daily.daily_metrics(state, ORDER_EVENTS),
            "quarantine": quarantine(spark, sf),
        }
    )


def monthly_audit(spark, sf) -> DataFrame:
    """Each order month stands for one run of the silver stage."""
    month = F.coalesce(F.date_format("parsed_timestamp", "yyyy-MM"), F.lit("none"))
    counts = contract.quality_counters(validated(spark, sf).withColumn("month", month), "month")
    counts = counts.select(
        "month",
        F.col("total_records").alias("input_records"),
        F.col("clean_records").alias("output_records"),
        F.col("bad_records").alias("rejected_records"),
        "rescued_records",
        F.format_string(
            "cleanRecords=%d,quarantineRows=%d", "clean_records", "quarantine_rows"
        ).alias("details"),
    )
    start = F.when(F.col("month") == "none", F.lit("1970-01")).otherwise(F.col("month"))
    return audit.stage_audit_rows(
        counts,
        "silver",
        F.concat(F.lit("month-"), "month"),
        F.concat(start, F.lit("-01")).cast("timestamp"),
    )


def upkeep_audit(spark, sf) -> DataFrame:
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    name = F.concat(F.lit("lake.sales.customer_"), F.col("c_custkey").cast("string"))
    good = customers.select(name.alias("table_name"))
    targets = good.unionAll(customers.select(F.col("c_name").alias("table_name")))
    known = customers.filter("c_mktsegment <> 'BUILDING'").select(name.alias("table_name"))
    message = F.expr(
        "CASE c_nationkey % 6 WHEN 0 THEN 'Permission denied on object' WHEN 1 THEN 'User is NOT AUTHORIZED' "
        "WHEN 2 THEN 'Access Denied by policy' WHEN 3 THEN 'disk full' "
        "WHEN 4 THEN 'Insufficient privileges for VACUUM' END"
    )
    failures = customers.filter("c_acctbal < 1000").select(
        name.alias("table_name"),
        F.lit("RuntimeException").alias("error_class"),
        message.alias("error_message"),
    )
    return audit.upkeep_audit_rows(
        targets, known, failures, "run-1", 72, True, 24, at("2026-01-10 02:00:00")
    )


def retention_risk(spark, sf) -> DataFrame:
    policies = spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "p_partkey",
        "p_size * 8 AS kept_hours",
        "p_partkey % 2 = 0 AS replay_required",
        "p_partkey % 300 AS max_lag_hours",
    )
    risk = audit.retention_at_risk(F.col("kept_hours"), F.col("replay_required"), F.col("max_lag_hours"))
    return policies.withColumn("at_risk", risk)


def permission_failures(spark, sf) -> DataFrame:
    message = F.expr(
        "CASE event_id % 7 WHEN 0 THEN 'PERMISSION_DENIED for ' || event_type "
        "WHEN 1 THEN 'User ' || CAST(user_id AS STRING) || ' is Not Authorized' WHEN 2 THEN 'HTTP 401 Unauthorized' "
        "WHEN 3 THEN 'access DENIED' WHEN 4 THEN 'Insufficient Privileges' WHEN 5 THEN 'timeout in ' || event_type END"
    )
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", message.alias("message"))
    return events.withColumn("permission_failure", is_permission_failure(F.col("message")))


def trusted_identifiers(spark, sf) -> DataFrame:
    def names(table, expression):
        return spark.read.parquet(f"{sf}/{table}.parquet").selectExpr(f"{expression} AS name")

    found = names("nation", "n_name")
    for table, expression in (
        ("nation", "'sales.' || n_name"),
        ("nation", "' lake.sales.' || n_name || ' '"),
        ("nation", "'a.b.c.' || n_name"),
        ("supplier", "s_name"),
        ("part", "p_name"),
        ("customer", "replace(c_name, '#', '_')"),
    ):
        found = found.unionAll(names(table, expression))
    return found.withColumn("trusted", is_trusted_name(F.col("name")))


def expired_versions(spark, sf) -> DataFrame:
    versions = (
        clean(spark, sf)
        .groupBy(
            F.dayofmonth("ingest_timestamp").cast("bigint").alias("version"),
            F.date_format("order_date", "yyyy-MM").alias("slice"),
            F.col("ingest_timestamp").alias("created_at"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    old = expired(versions, 180, at("2026-01-10 00:00:00"))
    return old.select("version", "slice", "rows", "created_at", "replaced_at")


def clicks(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def raw_files(spark, sf, keep_unknown: bool, days=(1, 2, 3), folder: str = "") -> str:
    """The raw events as JSON Lines, a folder per day."""
    folder = folder or own_folder(spark, "raw")
    fields = [F.col(c) for c in ORDER_EVENTS.raw]
    unknown = F.when(F.col(RESCUED).isNotNull(), F.lit("x")).alias("extra")
    record = F.to_json(F.struct(*fields, unknown)) if keep_unknown else F.to_json(F.struct(*fields))
    lines = order_events(spark, sf).select(
        F.coalesce(F.col(CORRUPT), record).alias("value"), F.dayofmonth("ingest_timestamp").alias("day")
    )
    for day in days:
        lines.filter(F.col("day") == day).select("value").write.text(f"{folder}/day={day}")
    return folder


def own_folder(spark, purpose: str) -> str:
    """A scratch folder that goes when the process ends."""
    return forget_later(spark, scratch_dir(spark, purpose))


def a_lake(spark, **changes) -> Lake:
    root = own_folder(spark, "lake")
    settings = {"slices": 8, "gold_slices": "month", "checkpoint": f"{root}/checkpoint"}
    return Lake(spark, Settings(root, **{**settings, **changes}))


def stream_json(spark, sf) -> DataFrame:
    folder = raw_files(spark, sf, keep_unknown=False)
    lake = a_lake(spark, raw_dir=f"{folder}/*", mode="json", multi_line=False)
    ingest(lake)
    ingest(lake)  # nothing new
    return lake.bronze.read().select(*ORDER_EVENTS.raw, RESCUED, CORRUPT)


def stream_rescue(spark, sf) -> DataFrame:
    folder = raw_files(spark, sf, keep_unknown=True)
    lake = a_lake(spark, raw_dir=f"{folder}/*", layout="lines")
    ingest(lake)
    ingest(lake)
    return lake.bronze.read().select(*ORDER_EVENTS.raw, RESCUED, CORRUPT)


def stream_input_counts(spark, sf) -> DataFrame:
    """Bronze audit of a run a day: the lines that its files hold, blank ones among them, and the rows it kept."""
    folder = own_folder(spark, "raw")
    lake = a_lake(spark, raw_dir=f"{folder}/*", layout="lines", stage_audit="stage_audit")
    blank = order_events(spark, sf).filter("eventVersion IS NULL")
    for day in (1, 2, 3):
        raw_files(spark, sf, True, (day,), folder)
        blank.filter(F.dayofmonth("ingest_timestamp") == day).select(F.lit(" ").alias("value")).write.mode("append").text(f"{folder}/day={day}")
        ingest(lake, at(DAYS[day - 1]))
    audit_rows = lake.stage_audit().withColumn("day", F.dayofmonth("run_timestamp"))
    return audit_rows.select("day", "input_records", "output_records", "status")


def stream_silver(spark, sf) -> DataFrame:
    """Files are added to one folder day by day; each run of the same query, with the same checkpoint,
    picks up those it has not seen and brings the keyed table up to date."""
    folder = own_folder(spark, "raw")
    lake = a_lake(spark, require_update_time=True, require_version=True, raw_dir=f"{folder}/*")
    for day in (1, 2, 3):
        raw_files(spark, sf, True, (day,), folder)
        follow(lake, at(DAYS[day - 1]))
    return lake.silver.read().select(*STATE)


def stream_array_files(spark, sf) -> DataFrame:
    """Each file holds one JSON array of events, as the whole-file layout takes them."""
    folder = own_folder(spark, "arrays")
    fields = F.struct(*[F.col(c) for c in ORDER_EVENTS.raw])
    events = order_events(spark, sf).filter(F.col(CORRUPT).isNull())
    part = F.pmod(F.xxhash64("orderId"), F.lit(16))
    arrays = events.groupBy(part.alias("part"), "ingest_timestamp").agg(F.to_json(F.collect_list(fields)).alias("value"))
    arrays.repartition(48, "part", "ingest_timestamp").select("value").write.option("maxRecordsPerFile", 1).text(folder)
    lake = a_lake(spark, raw_dir=folder, layout="auto")
    ingest(lake)
    return lake.bronze.read().select(*ORDER_EVENTS.raw)


def stream_split_files(spark, sf) -> DataFrame:
    """Arrays in a few large files, unreadable elements among them, cut by the default layout."""
    folder = own_folder(spark, "arrays")
    element = F.coalesce(F.concat(F.lit('"'), CORRUPT, F.lit('"')), F.to_json(F.struct(*ORDER_EVENTS.raw)))
    part = F.pmod(F.xxhash64("orderId"), F.lit(64))
    pieces = order_events(spark, sf).groupBy(part.alias("part")).agg(F.concat_ws(", ", F.collect_list(element)).alias("value"))
    arrays = pieces.select(F.concat(F.lit("[\n"), "value", F.lit("]")).alias("value"))
    arrays.repartition(64, "value").write.option("maxRecordsPerFile", 1).text(folder)
    lake = a_lake(spark, raw_dir=folder)
    ingest(lake)
    return lake.bronze.read().select(*ORDER_EVENTS.raw, RESCUED, CORRUPT)


def stream_latest_state(spark, sf) -> DataFrame:
    """Accepted events in files of any order; keyed state lets through what is newest so far, and the merge takes it."""
    folder = own_folder(spark, "accepted")
    accepted = clean(spark, sf)
    accepted.repartition(6, F.xxhash64("orderId", "event_version")).write.parquet(folder)
    lake = a_lake(spark, batch_order="version", require_update_time=True, require_version=True)
    arriving = spark.readStream.schema(accepted.schema).option("maxFilesPerTrigger", 3).parquet(folder)
    merge_newest(lake, arriving, own_folder(spark, "state"))
    return lake.silver.read().select(*STATE)


def stored_silver(spark, sf, broadcast_bytes: int = 0, after_each=lambda lake, day: None) -> Lake:
    lake = a_lake(spark, broadcast_bytes=broadcast_bytes)
    for day in (1, 2, 3):
        silver.merge_batch(lake, lake.silver, batch(spark, sf, day), day, at(AS_OF[day - 1]))
        after_each(lake, day)
    return lake


def compacted(spark, sf) -> DataFrame:
    # the small-batch merge leaves new keys in files of their own
    lake = stored_silver(spark, sf, broadcast_bytes=upsert.BROADCAST_BYTES)
    compact_slices(lake.silver)
    return lake.silver.read().select(*STATE)


def gold_recomputed(spark, sf) -> DataFrame:
    """The stored full recompute, twice: the second replaces the first."""
    lake = stored_silver(spark, sf)
    gold.recompute(lake, at(AS_OF[1]))
    gold.recompute(lake, at(AS_OF[2]))
    return lake.gold.read()


def merge_counts(spark, sf) -> DataFrame:
    """Rows that each day's merge inserted and updated."""
    lake, counts = a_lake(spark), []
    for day in (1, 2, 3):
        version = silver.merge_batch(lake, lake.silver, batch(spark, sf, day), day, at(AS_OF[day - 1]))
        found = lake.silver.changes_of(version)
        counts.append(found.select(F.lit(day).alias("day"), "inserted", "updated"))
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


def appended(spark, sf) -> DataFrame:
    """A plain table that the first day's events make and the others are appended to."""
    folder = own_folder(spark, "appended")
    rows = clean(spark, sf)
    for moment in DAYS:
        tables.append(rows.filter(F.col("ingest_timestamp") == at(moment)), folder)
    return spark.read.parquet(folder)


def without_optional_columns(spark, sf) -> DataFrame:
    """Events from before update times, versions and rescued data were kept."""
    old = order_events(spark, sf).drop("updatedAt", "eventVersion", RESCUED, CORRUPT)
    return contract.accepted(contract.validate(old, ORDER_EVENTS, LENIENT), ORDER_EVENTS).select(*STATE)


def stopped_by_breaker(spark, sf) -> DataFrame:
    """Too many unreadable records: the quarantine is written, the merge is not."""
    lake = a_lake(spark, production=True, max_rescued=0)
    try:
        silver.process_events(lake, order_events(spark, sf), "run-1", 1, at(AS_OF[0]))
    except silver.TooManyRescued:
        rows = lake.quarantine().drop("quarantined_at")
        return rows.withColumn("merged", F.lit(lake.silver.exists()))
    raise AssertionError("the run was not stopped")


def extreme_amounts(spark, sf) -> DataFrame:
    """Amounts below a cent, NaN and beyond 2 ** 57, which only a plain double sum keeps."""
    amount = F.expr(
        "CASE WHEN day(order_date) = 1 THEN 0.004D WHEN day(order_date) = 2 AND length(orderId) = 3 THEN double('NaN') "
        "WHEN day(order_date) = 3 THEN 144115188075855872D * length(orderId) ELSE amount END"
    )
    return daily.daily_metrics(latest(spark, sf).withColumn("amount", amount), ORDER_EVENTS)


def gold_from_changes(spark, sf) -> DataFrame:
    lake = stored_silver(spark, sf, after_each=lambda lake, day: gold.refresh(lake, at(AS_OF[day - 1])))
    return lake.gold.read().drop("gold_updated_at")


def gold_maintained(spark, sf) -> DataFrame:
    """Metrics of two days, with the third day's changes added to them and no row read again where that is enough."""
    _, before, now = silver_states(spark, sf, 3)
    metrics = keep(daily.daily_metrics_with_state(before, ORDER_EVENTS, at(AS_OF[1])), "metrics")
    track = {upsert.PREVIOUS_MEASURE: "amount", upsert.PREVIOUS_MARK: "ingest_timestamp"}
    merged = merge(before, batch(spark, sf, 3), track_date="order_date", track=track)
    earlier = {"date": upsert.PREVIOUS_DATE, "measure": upsert.PREVIOUS_MEASURE, "mark": upsert.PREVIOUS_MARK}
    changes = keep(daily.changes_by_date(merged.filter(F.col(upsert.CHANGE).isNotNull()), ORDER_EVENTS, earlier), "changes")
    fresh, again = daily.maintained_metrics(metrics, changes, ORDER_EVENTS, at(AS_OF[2]))
    again = keep(again, "again")
    fresh = fresh.unionByName(daily.refreshed_metrics(now, again, ORDER_EVENTS, at(AS_OF[2])))
    rest = metrics.join(changes.select("order_date"), "order_date", "left_anti")
    return rest.unionByName(fresh).drop(daily.ROWS, daily.SUM_PARTS, "gold_updated_at")


def rule(code: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        return (
            validated(spark, sf)
            .filter(F.array_contains(VIOLATIONS, code))
            .select(*ORDER_EVENTS.raw, "ingest_timestamp")
        )

    return run


def _registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    parsed = ["orderId", "eventVersion", "updatedAt", "parsed_updated_at"]
    checked = ["orderId", "customerId", "amount", "timestamp", "eventVersion", "errors"]
    out = {
        "raw_adapter": order_events,
        "normalize_trim": lambda s, d: contract.normalise(order_events(s, d), ORDER_EVENTS).select(
            "orderId", "customerId", "timestamp", "updatedAt", "eventVersion"
        ),
        "parse_event_ts": lambda s, d: validated(s, d).select(
            "orderId", "eventVersion", "timestamp", "parsed_timestamp"
        ),
        "parse_updated_at_strict": lambda s, d: validated(s, d).select(*parsed),
        "parse_updated_at_lenient": lambda s, d: validated(s, d, LENIENT).select(*parsed),
        "parse_updated_at_reject": lambda s, d: validated(
            s, d, Contract(bad_update_time="reject")
        ).select(*parsed),
        "validation_errors_strict": lambda s, d: with_error_text(validated(s, d)).select(*checked),
        "validation_errors_lenient": lambda s, d: with_error_text(validated(s, d, LENIENT)).select(*checked),
        "bad_records": lambda s, d: with_error_text(contract.rejected(validated(s, d))).select(
            *ORDER_EVENTS.raw, "errors"
        ),
        "clean_orders": lambda s, d: clean(s, d, LENIENT),
        "clean_orders_strict": clean,
        "legacy_order_date": lambda s, d: shape.derive_date(
            clean(s, d).select("orderId", "amount", "timestamp"), "order_date", "timestamp"
        ),
        "rejection_category": lambda s, d: quarantine(s, d)
        .groupBy(REASON, CATEGORY)
        .agg(F.count(F.lit(1)).alias("n")),
        "rescued_records": lambda s, d: contract.rejected(validated(s, d))
        .filter(contract.was_rescued())
        .select("orderId", "eventVersion", RESCUED, CORRUPT),
        "quarantine_rows": quarantine,
        "quarantine_summary": lambda s, d: contract.quarantine_summary(quarantine(s, d)),
        "quality_counters": lambda s, d: contract.quality_counters(validated(s, d)),
        "latest_per_order": latest,
        "latest_per_order_lenient": lambda s, d: newest(clean(s, d, LENIENT), LENIENT),
        "latest_version_first": lambda s, d: newest(clean(s, d), Contract.strict(batch_order="version")),
        "latest_nulls_last": lambda s, d: latest_per_key(
            contract.normalise(order_events(s, d), ORDER_EVENTS)
            .filter("orderId <> ''")
            .select("orderId", "eventVersion", "amount", "ingest_timestamp"),
            "orderId",
            ["eventVersion", "amount", "ingest_timestamp"],
        ).drop("ingest_timestamp"),
        "silver_merge": lambda s, d: silver_after(s, d, 3).select(*STATE),
        "silver_merge_small_batch": silver_small_batches,
        "silver_merge_bucketed": silver_bucketed,
        "silver_merge_cumulative": silver_cumulative,
        "silver_merge_changes": silver_changes,
        "silver_merge_evolved": silver_evolved,
        "silver_table": lambda s, d: stored_silver(s, d).silver.read().select(*STATE),
        "daily_metrics": lambda s, d: daily.daily_metrics(latest(s, d), ORDER_EVENTS),
        "daily_metrics_extremes": extreme_amounts,
        "gold_metrics": lambda s, d: gold_of(latest(s, d), 1),
        "date_high_water": lambda s, d: daily.high_water_marks(latest(s, d), ORDER_EVENTS),
        "gold_mv": gold_view,
        "affected_dates": dates_of_third_day,
        "affected_dates_exact": lambda s, d: dates_of_third_day(s, d, "exact"),
        "affected_silver": silver_on_affected_dates,
        "gold_full_refresh": lambda s, d: dates_of_third_day(s, d, without="source_max_ingest_timestamp"),
        "gold_merge": lambda s, d: gold_after(s, d, 3),
        "gold_merge_legacy_key": gold_legacy,
        "gold_incremental": lambda s, d: gold_after(s, d, 3),
        "gold_incremental_exact": lambda s, d: gold_after(s, d, 3, "exact").drop("gold_updated_at"),
        "gold_from_changes": gold_from_changes,
        "gold_maintained": gold_maintained,
        "table_counts": counts_of_tables,
        "order_lookup": lambda s, d: reports.lookup(latest(s, d), "orderId", ["o42"], LOOKUP),
        "orders_in_list": lambda s, d: reports.lookup(
            latest(s, d), "orderId", ["o1", "o2", "o77", "o1234"], LOOKUP
        ),
        "audit_report": lambda s, d: audit.audit_report(monthly_audit(s, d)),
        "stage_audit": monthly_audit,
        "stage_alerts": lambda s, d: audit.stage_alerts(monthly_audit(s, d), 0.8, 100).select(
            "stage_run_id", "input_records", "output_records", "rejected_records", "alert"
        ),
        "retention_risk": retention_risk,
        "permission_failures": permission_failures,
        "maintenance_audit": upkeep_audit,
        "maintenance_summary": lambda s, d: audit.upkeep_summary(upkeep_audit(s, d)),
        "maintenance_alerts": lambda s, d: audit.upkeep_alerts(upkeep_audit(s, d)),
        "trusted_identifiers": trusted_identifiers,
        "expired_versions": expired_versions,
        "events_latest_per_user": lambda s, d: latest_per_key(clicks(s, d), "user_id", ["ts", "event_id"], any_splits=True),
        "events_daily": lambda s, d: daily.daily_metrics(clicks(s, d), CLICKS),
        "stream_ingest_json": stream_json,
        "stream_ingest_rescue": stream_rescue,
        "stream_silver": stream_silver,
        "stream_input_counts": stream_input_counts,
        "stream_latest_state": stream_latest_state,
        "compaction": compacted,
        "stream_ingest_arrays": stream_array_files,
        "stream_ingest_split": stream_split_files,
        "gold_recomputed": gold_recomputed,
        "merge_counts": merge_counts,
        "append_twice": appended,
        "clean_orders_without_optional": without_optional_columns,
        "breaker_quarantine": stopped_by_breaker,
    }
    for r in ORDER_EVENTS.rules:
        out[f"rule_{r.code.lower()}"] = rule(r.code)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(query):
        return lambda spark, sf_dir: zoneless(query(configure(spark), sf_dir))

    return {name: prepared(query) for name, query in _registered().items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(daily.daily_metrics(latest(configure(spark), sf_dir), ORDER_EVENTS))
