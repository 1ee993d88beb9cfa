from datetime import date

import pytest
from pyspark.sql import functions as F
from tests.helpers import events, rows_of

from tidemark.operators.contract import (
    accepted,
    clean,
    quality_counters,
    quarantine_summary,
    rejected,
    rejections,
    validate,
)
from tidemark.spec import CORRUPT, ORDER_EVENTS, RESCUED, VIOLATIONS, Contract

GOOD = ("1", "c1", 100.0, "2023-10-27T10:00:00Z", "2023-10-27T10:05:00Z", 1)


def codes(df, contract=Contract()):
    return [r[0] for r in validate(df, ORDER_EVENTS, contract).select(VIOLATIONS).collect()]


def test_clean_keeps_valid_events_and_derives_columns(spark):
    raw = events(
        spark,
        ("  book ", " ann ", 12.5, " 2024-02-29 ", "2024-03-01 08:15:00 ", 7),
        ("lamp", "bob", 0.0, "2024-02-29T01:02:03", None, 3),
        ("   ", "cid", 9.0, "2024-02-29T01:02:03", None, 3),
        ("desk", " ", 9.0, "2024-02-29T01:02:03", None, 3),
        ("rug", "dora", 9.0, "2024-02-30", None, 3),
        ("sofa", "eve", 0.01, "2024-12-31T23:59:59.999Z", None, None),
    )
    got = clean(raw, ORDER_EVENTS)
    assert got.columns == [
        "orderId", "customerId", "amount", "timestamp", "ingest_timestamp", "updated_at",
        "event_version", "order_date",
    ]
    found = {r["orderId"]: r for r in got.collect()}
    assert set(found) == {"book", "sofa"}
    assert (found["book"]["customerId"], found["book"]["event_version"]) == ("ann", 7)
    assert [found[k]["order_date"] for k in ("book", "sofa")] == [date(2024, 2, 29), date(2024, 12, 31)]
    assert found["sofa"]["event_version"] is None and found["sofa"]["updated_at"] == found["sofa"]["timestamp"]
    assert found["book"]["updated_at"] > found["book"]["timestamp"]


def test_every_rejection_gets_its_reason_and_category(spark):
    raw = spark.createDataFrame(
        [
            (*GOOD, None),
            ("", "zoe", -0.5, "yesterday", None, None, None),
            ("cup", "yan", 4.0, "2024-01-01", "2024-01-02", 5, '{"colour":"red"}'),
        ],
        f"{ORDER_EVENTS.raw_schema}, {RESCUED} string",
    )
    checked = validate(raw, ORDER_EVENTS)
    assert accepted(checked, ORDER_EVENTS).count() == 1
    rows = rejections(rejected(checked), ORDER_EVENTS)
    assert rows_of(rows, "customerId", "rejection_reason", "rejection_category") == [
        ("yan", "RESCUED_DATA_PRESENT", "INGESTION"),
        ("zoe", "INVALID_TIMESTAMP", "SCHEMA"),
        ("zoe", "MISSING_ORDER_ID", "SCHEMA"),
        ("zoe", "NON_POSITIVE_AMOUNT", "BUSINESS_RULE"),
    ]
    assert "quarantined_at" in rows.columns and VIOLATIONS not in rows.columns
    assert rows.filter("rejection_reason = 'MISSING_ORDER_ID'").first()["orderId"] == ""
    assert quarantine_summary(rows).first()["records"] == 1


def test_all_rules_are_checked_and_blank_time_breaks_two(spark):
    raw = spark.createDataFrame(
        [("", None, 0.0, "  ", "junk", -1, "{}", "x")],
        f"{ORDER_EVENTS.raw_schema}, {RESCUED} string, {CORRUPT} string",
    )
    assert codes(raw) == [
        [
            "MISSING_ORDER_ID", "MISSING_CUSTOMER_ID", "NON_POSITIVE_AMOUNT", "MISSING_TIMESTAMP",
            "INVALID_TIMESTAMP", "INVALID_UPDATED_AT", "INVALID_EVENT_VERSION",
            "RESCUED_DATA_PRESENT", "CORRUPT_RECORD",
        ]
    ]


@pytest.mark.parametrize(
    "row, contract, reasons",
    [
        (("1", "c", 1.0, "2023-10-27", None, 1), Contract.strict(), ["MISSING_UPDATED_AT"]),
        (("1", "c", 1.0, "2023-10-27", "  ", 1), Contract.strict(), ["MISSING_UPDATED_AT"]),
        (("1", "c", 1.0, "2023-10-27", "2023-10-27", None), Contract.strict(), ["MISSING_EVENT_VERSION"]),
        (("1", "c", 1.0, "2023-10-27", "2023-10-27", None), Contract.strict(require_version=False), []),
        (("1", "c", 1.0, "2023-10-27", None, None), Contract(), []),
        (("1", "c", 1.0, "2023-10-27", "junk", 1), Contract(), []),
        (("1", "c", 1.0, "2023-10-27", "junk", 1), Contract(bad_update_time="reject"), ["INVALID_UPDATED_AT"]),
        (("1", "c", 1.0, "2023-10-27", None, 1), Contract(bad_update_time="reject"), []),
        (("1", "c", 1.0, "2023-10-27", "junk", 1), Contract.strict(), ["INVALID_UPDATED_AT"]),
        (("1", "c", None, "2023-10-27", None, 1), Contract(), ["MISSING_AMOUNT"]),
        (("1", "c", float("nan"), "2023-10-27", None, 1), Contract(), []),
        (("1", "c", 1.0, None, None, 1), Contract(), ["MISSING_TIMESTAMP"]),
        (("\t", "c", 1.0, "2023-10-27", None, 1), Contract(), []),
    ],
)
def test_contract_flags(spark, row, contract, reasons):
    assert codes(events(spark, row), contract) == [reasons]


def test_counters_take_one_pass_and_agree_with_the_split(spark):
    raw = events(spark, GOOD, ("", "c", -1.0, "x", None, None), ("2", "c", 0.0, "2023-10-27", None, None))
    checked = validate(raw, ORDER_EVENTS)
    counts = quality_counters(checked).first().asDict()
    assert counts == {
        "total_records": 3, "bad_records": 2, "rescued_records": 0, "clean_records": 1,
        "quarantine_rows": 4,
    }
    assert rejected(checked).count() + accepted(checked, ORDER_EVENTS).count() == 3
    assert quality_counters(checked.filter("false")).first()["quarantine_rows"] == 0


def test_unknown_reasons_are_labelled(spark):
    from tidemark.operators.contract import category_of

    df = spark.createDataFrame([("CORRUPT_RECORD",), ("SOMETHING_ELSE",)], "reason string")
    got = df.select(category_of(F.col("reason"), ORDER_EVENTS.rules)).collect()
    assert [r[0] for r in got] == ["INGESTION", "UNKNOWN"]
