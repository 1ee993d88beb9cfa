"""The registered queries again, as SQL for DuckDB."""

from __future__ import annotations

from checks.inputs import ORDER_EVENTS_SQL
from tidemark.functions.names import REFUSED
from tidemark.spec import ORDER_RULES, TIME_FORMATS

_STRPTIME = {
    "yyyy-MM-dd'T'HH:mm:ss.SSSX": "%Y-%m-%dT%H:%M:%S.%gZ",
    "yyyy-MM-dd'T'HH:mm:ssX": "%Y-%m-%dT%H:%M:%SZ",
    "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd": "%Y-%m-%d",
}


def _parse(column: str) -> str:
    formats = ", ".join(f"'{_STRPTIME[f]}'" for f in TIME_FORMATS)
    return f"try_strptime({column}, [{formats}])"


_TIMES = f"""
  SELECT *, {_parse('"timestamp"')} AS parsed_timestamp, {_parse('"updatedAt"')} AS stated
  FROM norm"""

# predicates per reason; the two flags of the strict contract are {strict}
_FIRES = {
    "MISSING_ORDER_ID": "coalesce(length(orderId), 0) = 0",
    "MISSING_CUSTOMER_ID": "coalesce(length(customerId), 0) = 0",
    "MISSING_AMOUNT": "amount IS NULL",
    "NON_POSITIVE_AMOUNT": "NOT amount > 0",
    "MISSING_TIMESTAMP": 'coalesce(length("timestamp"), 0) = 0',
    "INVALID_TIMESTAMP": '"timestamp" IS NOT NULL AND parsed_timestamp IS NULL',
    "MISSING_UPDATED_AT": "{strict} AND updatedAt IS NULL",
    "INVALID_UPDATED_AT": "updatedAt IS NOT NULL AND parsed_updated_at IS NULL",
    "MISSING_EVENT_VERSION": "{strict} AND eventVersion IS NULL",
    "INVALID_EVENT_VERSION": "eventVersion IS NOT NULL AND eventVersion < 0",
    "RESCUED_DATA_PRESENT": "_rescued_data IS NOT NULL",
    "CORRUPT_RECORD": "_corrupt_record IS NOT NULL",
}


def _errors(strict: bool) -> str:
    flag = "TRUE" if strict else "FALSE"
    cases = [f"CASE WHEN {p.format(strict=flag)} THEN '{code}' END" for code, p in _FIRES.items()]
    return f"concat_ws(',', {', '.join(cases)})"


_STATE = (
    'orderId, customerId, amount, "timestamp", ingest_timestamp, updated_at, event_version, order_date'
)


def _clean(validated: str) -> str:
    return f"""
  SELECT orderId, customerId, amount, parsed_timestamp AS "timestamp", ingest_timestamp,
         parsed_updated_at AS updated_at, eventVersion AS event_version,
         CAST(parsed_timestamp AS DATE) AS order_date
  FROM {validated}
  WHERE errors = '' AND parsed_timestamp IS NOT NULL AND parsed_updated_at IS NOT NULL"""


def _latest(rows: str, where: str = "TRUE", lead: str = "updated_at DESC NULLS LAST, event_version DESC NULLS LAST") -> str:
    return f"""
  SELECT {_STATE} FROM (
    SELECT *, row_number() OVER (PARTITION BY orderId ORDER BY {lead},
      ingest_timestamp DESC NULLS LAST, "timestamp" DESC NULLS LAST) AS place
    FROM {rows} WHERE {where}) WHERE place = 1"""


# a later update decides between equal versions and for events without one; else the version does
_NEWER = """CASE WHEN s.event_version IS NULL OR s.event_version = t.event_version THEN s.updated_at > t.updated_at
      ELSE s.event_version > coalesce(t.event_version, -1) END"""


def _merge(target: str, source: str) -> str:
    return f"""
  SELECT s.* FROM {source} s LEFT JOIN {target} t ON s.orderId = t.orderId
  WHERE t.orderId IS NULL OR coalesce({_NEWER}, FALSE)
  UNION ALL
  SELECT t.* FROM {target} t LEFT JOIN {source} s ON s.orderId = t.orderId
  WHERE s.orderId IS NULL OR NOT coalesce({_NEWER}, FALSE)"""


def _exact(x: str, scale: str = "1152921504606846976") -> str:
    """The double nearest to the exact sum: whole numbers of 2^-60, and a text, which DuckDB rounds only once."""
    units = f"sum(CAST(CASE WHEN isnan({x}) THEN 0 ELSE {x} * {scale} END AS HUGEINT))"
    return f"CASE WHEN bool_or(isnan({x})) THEN 'NaN'::DOUBLE ELSE CAST(CAST({units} AS VARCHAR) AS DOUBLE) / any_value({scale}) END"


_SUM = _exact("amount")


def _daily(state: str, as_of: str | None = None, mark: bool = True) -> str:
    columns = [f"order_date, count(orderId) AS totalOrders, {_SUM} AS totalRevenue"]
    if mark:
        columns.append("max(ingest_timestamp) AS source_max_ingest_timestamp")
    if as_of:
        columns.append(f"TIMESTAMP '{as_of}' AS gold_updated_at")
    return f"SELECT {', '.join(columns)} FROM {state} GROUP BY order_date"


def _affected(state: str, gold: str) -> str:
    return f"""
  SELECT s.order_date FROM
    (SELECT order_date, max(ingest_timestamp) AS m FROM {state} GROUP BY order_date) s
    LEFT JOIN {gold} g ON s.order_date = g.order_date
  WHERE g.order_date IS NULL OR s.m > g.source_max_ingest_timestamp"""


def _affected_exact(state: str, gold: str) -> str:
    return f"""
  SELECT coalesce(s.order_date, g.order_date) AS order_date FROM
    (SELECT order_date, max(ingest_timestamp) AS m, count(orderId) AS n, {_SUM} AS total FROM {state} GROUP BY order_date) s
    FULL OUTER JOIN {gold} g ON s.order_date = g.order_date
  WHERE s.order_date IS NULL OR g.order_date IS NULL
     OR s.m IS DISTINCT FROM g.source_max_ingest_timestamp OR s.n IS DISTINCT FROM g.totalOrders
     OR s.total IS DISTINCT FROM g.totalRevenue"""


_AS_OF = ("2026-01-01 01:00:00", "2026-01-02 01:00:00", "2026-01-03 01:00:00")


def _refresh(gold: str, state: str, dates: str, as_of: str) -> str:
    return f"""
  SELECT * FROM {gold} WHERE order_date NOT IN (SELECT order_date FROM {dates})
  UNION ALL
  SELECT * FROM ({_daily(state, as_of)}) WHERE order_date IN (SELECT order_date FROM {dates})"""


def _batch(day: int) -> str:
    return f"ingest_timestamp = TIMESTAMP '2026-01-0{day} 00:00:00'"


def _so_far(day: int) -> str:
    return f"ingest_timestamp <= TIMESTAMP '2026-01-0{day} 00:00:00'"


_REASONS = ", ".join(f"'{r.code}'" for r in ORDER_RULES)
_CATEGORY = "CASE " + " ".join(
    f"WHEN reason IN ({', '.join(repr(r.code) for r in ORDER_RULES if r.category == c)}) THEN '{c}'"
    for c in ("SCHEMA", "BUSINESS_RULE", "INGESTION")
) + " ELSE 'UNKNOWN' END"

_MONTHLY = """
  SELECT 'month-' || month AS stage_run_id, month, 'silver' AS stage_name, count(*) AS input_records,
         count(*) FILTER (WHERE errors = '') AS output_records,
         count(*) FILTER (WHERE errors <> '') AS rejected_records,
         count(*) FILTER (WHERE errors <> '' AND (_rescued_data IS NOT NULL OR _corrupt_record IS NOT NULL)) AS rescued_records,
         'SUCCESS' AS status,
         'cleanRecords=' || CAST(count(*) FILTER (WHERE errors = '') AS VARCHAR) || ',quarantineRows='
           || CAST(sum(CASE WHEN errors = '' THEN 0 ELSE length(errors) - length(replace(errors, ',', '')) + 1 END) AS VARCHAR) AS details
  FROM (SELECT *, coalesce(strftime(parsed_timestamp, '%Y-%m'), 'none') AS month FROM strict)
  GROUP BY month"""

_UPKEEP_FAILURES = """
  SELECT 'lake.sales.customer_' || CAST(c_custkey AS VARCHAR) AS name, 'RuntimeException' AS error_class,
         CASE c_nationkey % 6 WHEN 0 THEN 'Permission denied on object' WHEN 1 THEN 'User is NOT AUTHORIZED'
           WHEN 2 THEN 'Access Denied by policy' WHEN 3 THEN 'disk full'
           WHEN 4 THEN 'Insufficient privileges for VACUUM' ELSE NULL END AS message
  FROM customer WHERE c_acctbal < 1000"""

_UPKEEP = f"""
  SELECT 'run-1' AS maintenance_run_id, TIMESTAMP '2026-01-10 02:00:00' AS run_timestamp, t.table_name,
         CASE WHEN t.refused OR f.name IS NOT NULL THEN 'FAILED' WHEN NOT t.known THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
         (NOT t.refused AND f.name IS NOT NULL AND coalesce(regexp_matches(lower(f.message),
           'permission|not authorized|unauthorized|access denied|insufficient privileges'), FALSE)) AS permission_failure,
         TRUE AS retention_policy_risk, CAST(72 AS INTEGER) AS vacuum_retention_hours, TRUE AS audit_replay_required,
         CAST(24 AS INTEGER) AS slow_downstream_max_lag_hours,
         CASE WHEN t.refused THEN 'IllegalArgumentException' WHEN f.name IS NOT NULL THEN f.error_class END AS error_class,
         CASE WHEN t.refused THEN 'maintenanceTable{REFUSED}' || t.table_name
              WHEN f.name IS NOT NULL THEN f.message WHEN NOT t.known THEN 'Table does not exist' END AS error_message
  FROM (SELECT 'lake.sales.customer_' || CAST(c_custkey AS VARCHAR) AS table_name, FALSE AS refused,
               c_mktsegment <> 'BUILDING' AS known FROM customer
        UNION ALL SELECT c_name, TRUE, FALSE FROM customer) t
  LEFT JOIN ({_UPKEEP_FAILURES}) f ON f.name = t.table_name"""

CTES = {
    "raw": ORDER_EVENTS_SQL,
    "norm": """
  SELECT trim(orderId) AS orderId, trim(customerId) AS customerId, amount, trim("timestamp") AS "timestamp",
         nullif(trim(updatedAt), '') AS updatedAt, eventVersion, _rescued_data, _corrupt_record, ingest_timestamp
  FROM raw""",
    "times": _TIMES,
    "strict": f"SELECT *, {_errors(True)} AS errors FROM (SELECT *, stated AS parsed_updated_at FROM times)",
    "lenient": (
        f"SELECT *, {_errors(False)} AS errors FROM "
        "(SELECT *, coalesce(stated, parsed_timestamp) AS parsed_updated_at FROM times)"
    ),
    "clean": _clean("strict"),
    "clean_lenient": _clean("lenient"),
    "latest": _latest("clean"),
    "quarantine": f"""
  SELECT orderId, customerId, amount, "timestamp", updatedAt, eventVersion, _rescued_data, _corrupt_record,
         ingest_timestamp, reason AS rejection_reason, {_CATEGORY} AS rejection_category
  FROM (SELECT *, unnest(string_split(errors, ',')) AS reason FROM strict WHERE errors <> '')""",
    "b1": _latest("clean", _batch(1)),
    "b2": _latest("clean", _batch(2)),
    "b3": _latest("clean", _batch(3)),
    "s2": _merge("b1", "b2"),
    "s3": _merge("s2", "b3"),
    "c2": _latest("clean", _so_far(2)),
    "c3": _latest("clean", _so_far(3)),
    "sc2": _merge("b1", "c2"),
    "sc3": _merge("sc2", "c3"),
    "g1": _daily("b1", _AS_OF[0]),
    "d2": _affected("s2", "g1"),
    "g2": _refresh("g1", "s2", "d2", _AS_OF[1]),
    "d3": _affected("s3", "g2"),
    "g3": _refresh("g2", "s3", "d3", _AS_OF[2]),
    "gs2": _daily("s2", _AS_OF[1]),
    "ds3": _affected("s3", "gs2"),
    "gl3": _refresh("gs2", "s3", "ds3", _AS_OF[2]),
    "e1": (
        'SELECT orderId, customerId, amount, "timestamp", ingest_timestamp, '
        'coalesce("timestamp", ingest_timestamp) AS updated_at, CAST(NULL AS BIGINT) AS event_version, order_date FROM b1'
    ),
    "e2": _merge("e1", "b2"),
    "monthly": _MONTHLY,
    "upkeep": _UPKEEP,
}


def _q(body: str) -> str:
    wanted, todo = set(), [body]
    import re

    while todo:  # only the CTEs the query reads
        text = todo.pop()
        for name, sql in CTES.items():
            if name not in wanted and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                wanted.add(name)
                todo.append(sql)
    heads = [f"{name} AS MATERIALIZED ({sql})" for name, sql in CTES.items() if name in wanted]
    return (f"WITH {', '.join(heads)}\n" if heads else "") + body


def oracles() -> dict[str, str]:
    out = {
        "raw_adapter": "SELECT * FROM raw",
        "normalize_trim": 'SELECT orderId, customerId, "timestamp", updatedAt, eventVersion FROM norm',
        "parse_event_ts": 'SELECT orderId, eventVersion, "timestamp", parsed_timestamp FROM times',
        "parse_updated_at_strict": "SELECT orderId, eventVersion, updatedAt, parsed_updated_at FROM strict",
        "parse_updated_at_lenient": "SELECT orderId, eventVersion, updatedAt, parsed_updated_at FROM lenient",
        "parse_updated_at_reject": (
            "SELECT orderId, eventVersion, updatedAt, "
            "CASE WHEN updatedAt IS NULL THEN parsed_timestamp ELSE stated END AS parsed_updated_at FROM times"
        ),
        "validation_errors_strict": 'SELECT orderId, customerId, amount, "timestamp", eventVersion, errors FROM strict',
        "validation_errors_lenient": 'SELECT orderId, customerId, amount, "timestamp", eventVersion, errors FROM lenient',
        "bad_records": 'SELECT orderId, customerId, amount, "timestamp", updatedAt, eventVersion, errors FROM strict WHERE errors <> \'\'',
        "clean_orders": f"SELECT {_STATE} FROM clean_lenient",
        "clean_orders_strict": f"SELECT {_STATE} FROM clean",
        "legacy_order_date": 'SELECT orderId, amount, "timestamp", order_date FROM clean',
        "rejection_category": (
            "SELECT rejection_reason, rejection_category, count(*) AS n FROM quarantine GROUP BY ALL"
        ),
        "rescued_records": (
            "SELECT orderId, eventVersion, _rescued_data, _corrupt_record FROM strict "
            "WHERE errors <> '' AND (_rescued_data IS NOT NULL OR _corrupt_record IS NOT NULL)"
        ),
        "quarantine_rows": "SELECT * FROM quarantine",
        "quarantine_summary": (
            "SELECT rejection_category, rejection_reason, count(*) AS records FROM quarantine GROUP BY ALL"
        ),
        "quality_counters": (
            "SELECT count(*) AS total_records, count(*) FILTER (WHERE errors <> '') AS bad_records, "
            "count(*) FILTER (WHERE errors <> '' AND (_rescued_data IS NOT NULL OR _corrupt_record IS NOT NULL)) AS rescued_records, "
            "count(*) FILTER (WHERE errors = '') AS clean_records, "
            "CAST(sum(CASE WHEN errors = '' THEN 0 ELSE length(errors) - length(replace(errors, ',', '')) + 1 END) AS BIGINT) AS quarantine_rows "
            "FROM strict"
        ),
        "latest_per_order": f"SELECT {_STATE} FROM latest",
        "latest_per_order_lenient": _latest("clean_lenient"),
        "latest_version_first": _latest(
            "clean", lead="event_version DESC NULLS LAST, updated_at DESC NULLS LAST"
        ),
        "latest_nulls_last": (
            "SELECT orderId, eventVersion, amount FROM (SELECT *, row_number() OVER (PARTITION BY orderId "
            "ORDER BY eventVersion DESC NULLS LAST, amount DESC NULLS LAST, ingest_timestamp DESC NULLS LAST) AS place "
            "FROM norm WHERE orderId <> '') WHERE place = 1"
        ),
        "silver_merge": f"SELECT {_STATE} FROM s3",
        "silver_merge_small_batch": f"SELECT {_STATE} FROM s3",
        "silver_merge_bucketed": f"SELECT {_STATE} FROM s3",
        "silver_merge_cumulative": f"SELECT {_STATE} FROM sc3",
        "silver_merge_changes": f"""
  SELECT s.orderId, CASE WHEN t.orderId IS NULL THEN 'insert' ELSE 'update' END AS change,
         s.order_date, t.order_date AS previous_date
  FROM b3 s LEFT JOIN s2 t ON s.orderId = t.orderId
  WHERE t.orderId IS NULL OR coalesce({_NEWER}, FALSE)""",
        "silver_merge_evolved": _merge("e2", "b3"),
        "daily_metrics": _daily("latest", mark=False),
        "gold_metrics": _daily("latest", _AS_OF[0]),
        "date_high_water": (
            "SELECT order_date, max(ingest_timestamp) AS source_max_ingest_timestamp FROM latest GROUP BY order_date"
        ),
        "gold_mv": _daily("s3"),
        "affected_dates": _affected("s3", "gs2"),
        "affected_dates_exact": _affected_exact("s3", "gs2"),
        "affected_silver": f"SELECT {_STATE} FROM s3 WHERE order_date IN (SELECT order_date FROM ds3)",
        "gold_full_refresh": "SELECT DISTINCT order_date FROM s3",
        "gold_merge": "SELECT * FROM g3",
        "gold_merge_legacy_key": (
            'SELECT order_date AS "timestamp", totalOrders, totalRevenue, source_max_ingest_timestamp FROM gl3'
        ),
        "gold_incremental": "SELECT * FROM g3",
        "gold_incremental_exact": _daily("s3"),
        "gold_from_changes": _daily("s3"),
        "table_counts": (
            "SELECT 'bronze' AS table_name, count(*) AS row_count FROM raw "
            "UNION ALL SELECT 'silver', count(*) FROM latest "
            "UNION ALL SELECT 'gold', count(DISTINCT order_date) FROM latest "
            "UNION ALL SELECT 'quarantine', count(*) FROM quarantine"
        ),
        "order_lookup": (
            "SELECT orderId, customerId, amount, order_date, updated_at, event_version FROM latest WHERE orderId = 'o42'"
        ),
        "orders_in_list": (
            "SELECT orderId, customerId, amount, order_date, updated_at, event_version FROM latest "
            "WHERE orderId IN ('o1', 'o2', 'o77', 'o1234')"
        ),
        "audit_report": (
            "SELECT stage_name, input_records, output_records, rejected_records, rescued_records, status, details FROM monthly"
        ),
        "stage_audit": (
            "SELECT stage_run_id, CAST(CASE WHEN month = 'none' THEN '1970-01' ELSE month END || '-01' AS TIMESTAMP) AS run_timestamp, "
            "stage_name, input_records, output_records, rejected_records, rescued_records, status, details FROM monthly"
        ),
        "stage_alerts": """
  SELECT stage_run_id, input_records, output_records, rejected_records, 'ZERO_OUTPUT' AS alert FROM monthly
  WHERE input_records > 0 AND output_records = 0
  UNION ALL
  SELECT stage_run_id, input_records, output_records, rejected_records, 'LOW_OUTPUT_RATIO' FROM monthly
  WHERE input_records > 0 AND output_records > 0 AND CAST(output_records AS DOUBLE) / input_records < 0.8
  UNION ALL
  SELECT stage_run_id, input_records, output_records, rejected_records, 'TOO_MANY_REJECTED' FROM monthly
  WHERE rejected_records > 100""",
        "retention_risk": (
            "SELECT p_partkey, p_size * 8 AS kept_hours, p_partkey % 2 = 0 AS replay_required, p_partkey % 300 AS max_lag_hours, "
            "p_size * 8 < greatest(CASE WHEN p_partkey % 2 = 0 THEN 168 ELSE 0 END, p_partkey % 300) AS at_risk FROM part"
        ),
        "permission_failures": """
  SELECT event_id, message, coalesce(regexp_matches(lower(message),
    'permission|not authorized|unauthorized|access denied|insufficient privileges'), FALSE) AS permission_failure
  FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'PERMISSION_DENIED for ' || event_type
      WHEN 1 THEN 'User ' || CAST(user_id AS VARCHAR) || ' is Not Authorized' WHEN 2 THEN 'HTTP 401 Unauthorized'
      WHEN 3 THEN 'access DENIED' WHEN 4 THEN 'Insufficient Privileges' WHEN 5 THEN 'timeout in ' || event_type END AS message
    FROM events)""",
        "maintenance_audit": "SELECT * FROM upkeep",
        "maintenance_summary": (
            "SELECT maintenance_run_id, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, "
            "count(*) FILTER (WHERE status = 'SKIPPED') AS skipped, count(*) FILTER (WHERE status = 'FAILED') AS failed, "
            "count(*) FILTER (WHERE permission_failure) AS permission_failures FROM upkeep GROUP BY maintenance_run_id"
        ),
        "maintenance_alerts": """
  SELECT maintenance_run_id, failed, permission_failures, alert FROM
    (SELECT maintenance_run_id, count(*) FILTER (WHERE status = 'FAILED') AS failed,
            count(*) FILTER (WHERE permission_failure) AS permission_failures, bool_or(retention_policy_risk) AS risk
     FROM upkeep GROUP BY maintenance_run_id) r
    JOIN (VALUES ('RETENTION_RISK'), ('UPKEEP_FAILURES'), ('PERMISSION_PROBLEM')) a(alert)
      ON (alert = 'RETENTION_RISK' AND risk) OR (alert = 'UPKEEP_FAILURES' AND failed > 0)
      OR (alert = 'PERMISSION_PROBLEM' AND permission_failures > 0)""",
        "trusted_identifiers": """
  SELECT name, regexp_full_match(trim(name), '[A-Za-z_][A-Za-z0-9_]*(\\.[A-Za-z_][A-Za-z0-9_]*){0,2}') AS trusted
  FROM (SELECT n_name AS name FROM nation UNION ALL SELECT 'sales.' || n_name FROM nation
        UNION ALL SELECT ' lake.sales.' || n_name || ' ' FROM nation UNION ALL SELECT 'a.b.c.' || n_name FROM nation
        UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_name FROM part
        UNION ALL SELECT replace(c_name, '#', '_') FROM customer)""",
        "expired_versions": """
  SELECT version, slice, rows, created_at, replaced_at FROM (
    SELECT *, lead(created_at) OVER (PARTITION BY slice ORDER BY version) AS replaced_at FROM (
      SELECT CAST(day(ingest_timestamp) AS BIGINT) AS version, strftime(order_date, '%Y-%m') AS slice,
             count(*) AS rows, ingest_timestamp AS created_at
      FROM clean GROUP BY ALL))
  WHERE replaced_at < TIMESTAMP '2026-01-02 12:00:00'""",
        "events_latest_per_user": """
  SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS place
    FROM events) WHERE place = 1""",
        "events_daily": (
            "SELECT CAST(ts AS DATE) AS event_date, count(event_id) AS events, "
            f"{_exact('value')} AS total_value FROM events GROUP BY 1"
        ),
        "stream_ingest_json": (
            "SELECT CASE WHEN _corrupt_record IS NULL THEN orderId END AS orderId, "
            "CASE WHEN _corrupt_record IS NULL THEN customerId END AS customerId, "
            "CASE WHEN _corrupt_record IS NULL THEN amount END AS amount, "
            "CASE WHEN _corrupt_record IS NULL THEN \"timestamp\" END AS \"timestamp\", "
            "CASE WHEN _corrupt_record IS NULL THEN updatedAt END AS updatedAt, "
            "CASE WHEN _corrupt_record IS NULL THEN eventVersion END AS eventVersion, "
            "CAST(NULL AS VARCHAR) AS _rescued_data, _corrupt_record FROM raw"
        ),
        "stream_ingest_rescue": (
            "SELECT CASE WHEN _corrupt_record IS NULL THEN orderId END AS orderId, "
            "CASE WHEN _corrupt_record IS NULL THEN customerId END AS customerId, "
            "CASE WHEN _corrupt_record IS NULL THEN amount END AS amount, "
            "CASE WHEN _corrupt_record IS NULL THEN \"timestamp\" END AS \"timestamp\", "
            "CASE WHEN _corrupt_record IS NULL THEN updatedAt END AS updatedAt, "
            "CASE WHEN _corrupt_record IS NULL THEN eventVersion END AS eventVersion, "
            "CASE WHEN _corrupt_record IS NULL THEN _rescued_data END AS _rescued_data, _corrupt_record FROM raw"
        ),
        "stream_silver": f"SELECT {_STATE} FROM s3",
        "stream_input_counts": (
            "SELECT CAST(day(ingest_timestamp) AS INTEGER) AS day, "
            "count(*) + count(*) FILTER (WHERE eventVersion IS NULL) AS input_records, count(*) AS output_records, "
            "'SUCCESS' AS status FROM raw GROUP BY 1"
        ),
        "silver_table": f"SELECT {_STATE} FROM s3",
        "compaction": f"SELECT {_STATE} FROM s3",
        "stream_ingest_arrays": (
            'SELECT orderId, customerId, amount, "timestamp", updatedAt, eventVersion FROM raw WHERE _corrupt_record IS NULL'
        ),
        "gold_maintained": _daily("s3"),
        "gold_recomputed": _daily("s3", _AS_OF[2]),
        "merge_counts": " UNION ALL ".join(
            f"SELECT {day} AS day, count(*) FILTER (WHERE t.orderId IS NULL) AS inserted, "
            f"count(*) FILTER (WHERE t.orderId IS NOT NULL AND coalesce({_NEWER}, FALSE)) AS updated "
            f"FROM b{day} s LEFT JOIN {before} t ON s.orderId = t.orderId"
            for day, before in ((1, "(SELECT * FROM b1 WHERE FALSE)"), (2, "b1"), (3, "s2"))
        ),
        "append_twice": f"SELECT {_STATE} FROM clean",
        "clean_orders_without_optional": """
  SELECT orderId, customerId, amount, parsed_timestamp AS "timestamp", ingest_timestamp, parsed_timestamp AS updated_at,
         CAST(NULL AS BIGINT) AS event_version, CAST(parsed_timestamp AS DATE) AS order_date
  FROM times WHERE orderId <> '' AND customerId <> '' AND amount > 0 AND parsed_timestamp IS NOT NULL""",
        "breaker_quarantine": "SELECT *, FALSE AS merged FROM quarantine",
        "daily_metrics_extremes": f"""
  SELECT order_date, count(orderId) AS totalOrders, {_exact('amount', "(CASE WHEN day(order_date) = 3 THEN 1 ELSE 1152921504606846976 END)")} AS totalRevenue FROM (
    SELECT orderId, order_date, CASE WHEN day(order_date) = 1 THEN 0.004::DOUBLE
        WHEN day(order_date) = 2 AND length(orderId) = 3 THEN 'NaN'::DOUBLE
        WHEN day(order_date) = 3 THEN 144115188075855872::DOUBLE * length(orderId) ELSE amount END AS amount
    FROM latest) GROUP BY order_date""",
    }
    out["stream_latest_state"] = out["latest_version_first"]
    out["stream_ingest_split"] = out["stream_ingest_json"]
    for code, predicate in _FIRES.items():
        out[f"rule_{code.lower()}"] = (
            'SELECT orderId, customerId, amount, "timestamp", updatedAt, eventVersion, ingest_timestamp '
            f"FROM strict WHERE {predicate.format(strict='TRUE')}"
        )
    return {name: _q(sql) for name, sql in out.items()}
