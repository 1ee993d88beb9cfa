"""Stages on disk, from raw files to metrics."""

from datetime import date, datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tests.helpers import events, rows_of, write_array, write_lines

from tidemark.operators.daily import affected_dates, daily_metrics, daily_metrics_with_mark
from tidemark.plans import gold, silver, upkeep
from tidemark.plans.lake import Lake, Settings
from tidemark.plans.pipeline import follow, run
from tidemark.sources.tables import SlicedTable, date_slice, file_sizes
from tidemark.sources.upkeep import compact_slices
from tidemark.spec import CORRUPT, ORDER_EVENTS, RESCUED
from tidemark.streaming.ingest import ingest

# The events and results of the documented run, which the stages must reproduce.
DAY_ONE = [
    ("o100", "c100", 120.50, "2026-05-15T10:00:00Z", "2026-05-15T10:05:00Z", 1),
    ("o101", "c101", 80.00, "2026-05-15T11:00:00Z", "2026-05-15T11:05:00Z", 1),
    ("o100", "c100", 150.50, "2026-05-15T12:00:00Z", "2026-05-15T12:05:00Z", 2),
    ("o101", "c101", 70.00, "2026-05-15T09:00:00Z", "2026-05-15T09:05:00Z", 0),
    ("o102", "c102", -5.00, "2026-05-15T13:00:00Z", "2026-05-15T13:05:00Z", 1),
    ("o103", "", 40.00, "2026-05-15T14:00:00Z", "2026-05-15T14:05:00Z", 1),
    ("o104", "c104", 30.00, "2026-05-15T15:00:00Z", None, 1),
]
DAY_TWO = [
    ("o101", "c101", 95.00, "2026-05-15T16:00:00Z", "2026-05-15T16:05:00Z", 2),
    ("o105", "c105", 25.00, "2026-05-16T09:00:00Z", "2026-05-16T09:05:00Z", 1),
]


def lake_at(spark, tmp_path, **changes) -> Lake:
    settings = Settings(
        str(tmp_path / "lake"),
        raw_dir=str(tmp_path / "raw"),
        checkpoint=str(tmp_path / "checkpoint"),
        slices=4,
        stage_audit="stage_audit",
        upkeep_audit="maintenance_audit",
    )
    return Lake(spark, replace(settings, **changes))


def put(lake, df, name, mark=datetime(2026, 1, 1)):
    """Append events to Bronze without files."""
    lake.bronze.replace(df.withColumn("ingest_timestamp", F.lit(mark)), kind="append", into=name)


SILVER = ("orderId", "amount", "event_version")
GOLD = ("order_date", "totalOrders", "totalRevenue")


@pytest.mark.parametrize("detect", ["changes", "exact", "ingest"])
def test_two_runs_end_to_end(spark, tmp_path, detect):
    lake = lake_at(
        spark, tmp_path, mode="json", production=True, detect=detect, broadcast_bytes=0
    )
    write_array(tmp_path / "raw", "one.json", DAY_ONE)
    run(lake)
    assert lake.bronze.read().count() == 7
    assert rows_of(lake.silver.read(), *SILVER) == [("o100", 150.5, 2), ("o101", 80.0, 1)]
    assert rows_of(lake.quarantine(), "orderId", "rejection_reason", "rejection_category") == [
        ("o102", "NON_POSITIVE_AMOUNT", "BUSINESS_RULE"),
        ("o103", "MISSING_CUSTOMER_ID", "SCHEMA"),
        ("o104", "MISSING_UPDATED_AT", "SCHEMA"),
    ]
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 5, 15), 2, 230.5)]
    audit = {r["stage_name"]: r for r in lake.stage_audit().collect()}
    assert sorted(audit) == ["bronze", "gold", "silver"]
    assert (audit["bronze"]["input_records"], audit["bronze"]["output_records"]) == (7, 7)
    assert (audit["silver"]["input_records"], audit["silver"]["output_records"]) == (7, 2)
    assert audit["silver"]["rejected_records"] == 3
    assert audit["silver"]["details"].startswith("cleanRecords=4,quarantineRows=3")
    assert audit["gold"]["details"] == "affectedDates=1"
    upkept = lake.upkeep_audit().collect()
    # the audit of this run makes its table only afterwards
    assert {r["table_name"]: r["status"] for r in upkept} == dict.fromkeys(
        ("bronze_orders", "silver_orders", "gold_daily_metrics", "quarantine_orders", "stage_audit"), "SUCCESS")

    write_array(tmp_path / "raw", "two.json", DAY_TWO)
    run(lake)
    assert rows_of(lake.silver.read(), *SILVER) == [
        ("o100", 150.5, 2), ("o101", 95.0, 2), ("o105", 25.0, 1)
    ]
    assert rows_of(lake.gold.read(), *GOLD) == [
        (date(2026, 5, 15), 2, 245.5), (date(2026, 5, 16), 1, 25.0)
    ]
    assert lake.quarantine().count() == 3

    before = lake.stage_audit().count()
    assert run(lake, "gold")["gold"] is None  # nothing to do leaves no audit row
    assert lake.stage_audit().count() == before
    lake.register_views()
    found = spark.sql("SELECT sum(totalRevenue) FROM gold_daily_metrics").first()[0]
    assert found == 270.5


def test_reading_all_of_bronze_again_rejects_again(spark, tmp_path):
    lake = lake_at(spark, tmp_path, production=True, read="all")
    put(lake, events(spark, *DAY_ONE), "one")
    silver.process(lake)
    put(lake, events(spark, *DAY_TWO), "two", datetime(2026, 1, 2))
    silver.process(lake)
    assert lake.quarantine().count() == 6
    assert rows_of(lake.silver.read(), *SILVER) == [
        ("o100", 150.5, 2), ("o101", 95.0, 2), ("o105", 25.0, 1)
    ]


@pytest.mark.parametrize("detect, first_day", [("ingest", (2, 350000.0)), ("changes", (1, 100000.0)), ("exact", (1, 100000.0))])
def test_order_that_moves_to_another_day(spark, tmp_path, detect, first_day):
    lake = lake_at(spark, tmp_path, detect=detect)
    at = lambda d, t: f"2026-05-{d}T{t}:00Z"
    first = events(
        spark,
        ("o1", "c1", 100000.0, at(12, "10:00"), at(12, "10:05"), 1),
        ("o2", "c2", 250000.0, at(12, "11:00"), at(12, "11:03"), 1),
        (None, "c3", 300000.0, at(12, "12:00"), at(12, "12:01"), 1),
    )
    second = events(
        spark,
        ("o4", "c4", 500000.0, at(13, "10:00"), at(13, "10:02"), 1),
        ("o2", "c5", 258000.0, at(13, "11:00"), at(13, "11:10"), 2),
        ("o3", "c6", 800000.0, at(13, "12:00"), at(13, "12:05"), 1),
    )
    put(lake, first, "one")
    silver.process(lake)
    gold.refresh(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 5, 12), 2, 350000.0)]
    put(lake, second, "two", datetime(2026, 1, 2))
    silver.process(lake)
    gold.refresh(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [
        (date(2026, 5, 12), *first_day), (date(2026, 5, 13), 3, 1558000.0)
    ]
    assert lake.quarantine().count() == 1
    gold.recompute(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [
        (date(2026, 5, 12), 1, 100000.0), (date(2026, 5, 13), 3, 1558000.0)
    ]


def test_date_that_loses_its_last_order_disappears(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, ("a", "c", 1.0, "2026-01-01", "2026-01-01", 1)), "one")
    silver.process(lake)
    gold.refresh(lake)
    put(lake, events(spark, ("a", "c", 2.0, "2026-01-02", "2026-01-02", 2)), "two")
    put(lake, events(spark, ("a", "c", 3.0, "2026-01-03", "2026-01-03", 3)), "three")
    silver.process(lake)
    gold.refresh(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 1, 3), 1, 3.0)]


def test_dates_between_two_metric_runs_are_not_forgotten(spark, tmp_path):
    """The keyed table moves on twice before the metrics follow."""
    lake = lake_at(spark, tmp_path)
    for i, day in enumerate(["2026-01-01", "2026-01-02", "2026-01-03"], start=1):
        put(lake, events(spark, ("a", "c", float(i), day, day, i), ("b", "c", 5.0, "2026-01-09", "2026-01-09", 1)), f"n{i}")
        silver.process(lake)
        if i == 1:
            gold.refresh(lake)
    gold.refresh(lake)
    want = daily_metrics(lake.silver.read(), ORDER_EVENTS)
    assert rows_of(lake.gold.read(), *GOLD) == rows_of(want, *GOLD)


def test_changes_are_added_to_the_metrics_without_reading_the_table(spark, tmp_path, monkeypatch):
    lake = lake_at(spark, tmp_path)
    many = [(f"k{i}", "c", 0.1 * i, "2026-01-01", "2026-01-01", 1) for i in range(200)]
    put(lake, events(spark, *many), "one")
    silver.process(lake)
    gold.refresh(lake)
    later = [("k7", "c", 2.5, "2026-01-01", "2026-01-02", 2), ("k8", "c", 9.0, "2026-01-02", "2026-01-02", 2), ("n", "c", 0.3, "2026-01-01", "2026-01-02", 1)]
    put(lake, events(spark, *later), "two", datetime(2026, 1, 2))
    silver.process(lake)

    def refuse(*args):
        raise AssertionError("rows were read again")

    monkeypatch.setattr(gold, "refreshed_metrics", refuse)
    gold.refresh(lake)
    want = daily_metrics_with_mark(lake.silver.read(), ORDER_EVENTS)
    assert rows_of(lake.gold.read(), *GOLD, "source_max_ingest_timestamp") == rows_of(want, *GOLD, "source_max_ingest_timestamp")
    audit = lake.stage_audit().filter("stage_name = 'gold'").orderBy(F.desc("run_timestamp")).first()
    assert (audit["input_records"], audit["output_records"], audit["details"]) == (200, 2, "affectedDates=2")


def test_older_version_never_wins(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, ("o1", "c1", 100.0, "2026-05-12T10:00:00Z", "2026-05-12T10:05:00Z", 2)), "one")
    silver.process(lake)
    put(
        lake,
        events(
            spark,
            ("o1", "c1", 999.0, "2026-05-12T10:00:00Z", "2026-05-12T10:01:00Z", 1),
            ("o1", "c1", 150.0, "2026-05-12T10:00:00Z", "2026-05-12T10:10:00Z", 3),
        ),
        "two",
    )
    silver.process(lake)
    assert rows_of(lake.silver.read(), *SILVER) == [("o1", 150.0, 3)]


def test_only_touched_slices_are_rewritten(spark, tmp_path):
    lake = lake_at(spark, tmp_path, slices=8, broadcast_bytes=0)
    many = [(f"k{i}", "c", 1.0, "2026-01-01", "2026-01-01", 1) for i in range(200)]
    put(lake, events(spark, *many), "one")
    silver.process(lake)
    put(lake, events(spark, ("k7", "c", 2.0, "2026-01-01", "2026-01-02", 2)), "two")
    silver.process(lake)
    held = lake.silver.snapshot().slices
    assert sorted(h.version for h in held.values()) == [1] * 7 + [2]
    assert lake.silver.read().count() == 200


def test_large_slices_are_spread_over_tasks(spark, tmp_path):
    lake = lake_at(spark, tmp_path, slices=2, rows_per_task=20, broadcast_bytes=0)
    rows = [(f"k{i}", "c", 1.0, "2026-01-01", "2026-01-01", 1) for i in range(200)]
    for name, version in (("one", 1), ("two", 2)):
        put(lake, events(spark, *[(*r[:5], version) for r in rows]), name)
        silver.process(lake)
    got = lake.silver.read()
    assert got.count() == 200 and got.filter("event_version = 2").count() == 200
    assert got.select("_metadata.file_path").distinct().count() > 6


def test_breaker_stops_the_merge_after_the_quarantine(spark, tmp_path):
    lake = lake_at(spark, tmp_path, production=True, max_rescued=0)
    good = ("1", "c1", 100.0, "2023-10-27T10:00:00Z", "2023-10-27T10:05:00Z", 1)
    put(lake, events(spark, good).withColumn(RESCUED, F.lit('{"extra":"value"}')), "one")
    for _ in range(2):  # a repeated run does not quarantine twice
        with pytest.raises(silver.TooManyRescued, match="1 records could not be read in full, more than the 0 allowed"):
            silver.process(lake)
        assert lake.quarantine().count() == 1
    assert not lake.silver.exists()


def test_contract_switches(spark, tmp_path):
    lake = lake_at(spark, tmp_path, production=True, require_version=False)
    put(lake, events(spark, ("1", "c1", 100.0, "2023-10-27T10:00:00Z", "2023-10-27T10:05:00Z", None)), "one")
    alerts = silver.process(lake)
    assert lake.silver.read().count() == 1
    assert lake.quarantine() is None
    assert alerts.count() == 0


def test_alerts_of_a_run(spark, tmp_path):
    lake = lake_at(spark, tmp_path, max_rejected=1)
    bad = [("", "c", 1.0, "2023-10-27", None, None)] * 2
    put(lake, events(spark, *bad), "one")
    assert sorted(r["alert"] for r in silver.process(lake).collect()) == ["TOO_MANY_REJECTED", "ZERO_OUTPUT"]
    quiet = lake_at(spark, tmp_path / "quiet", max_rejected=1, alert_on_anomaly=False)
    put(quiet, events(spark, *bad), "one")
    assert silver.process(quiet).count() == 0
    # all events were bad: they are done with nevertheless
    assert silver.process(lake).count() == 0 and lake.quarantine().count() == 2


@pytest.mark.parametrize("name", ["default.silver_orders; DROP TABLE default.x", "a.b.c.d", "1x", ""])
def test_untrusted_table_names_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError, match="trusted table"):
        lake_at(spark, tmp_path, silver=name)


# -- ingest ------------------------------------------------------------------


def bronze(lake):
    return rows_of(lake.bronze.read(), "orderId", "amount", RESCUED, CORRUPT)


def test_rescue_mode_reads_every_kind_of_file(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path), tmp_path / "raw"
    row = ("x", "c", 1.0, "2026-01-01", "2026-01-01", 1)
    write_array(raw, "array.json", [("a1", *row[1:]), ("a2", *row[1:])])
    write_lines(raw, "lines.json", [("l1", *row[1:]), "", ("l2", *row[1:])])
    write_array(raw, "mistyped.json", [("m1", *row[1:]), {"orderId": "m2", "amount": "much", "eventVersion": 1}])
    write_lines(raw, "extra.json", ['{"orderId":"e1","amount":2,"unexpected":{"a":[1,2]}}'])
    write_lines(raw, "single.json", ['{', '  "orderId": "s1",', '  "amount": 3', '}'])
    write_lines(raw, "broken.json", ['{"orderId": "b1", "amo', '{"orderId":"b2","amount":4}'])
    (raw / "cut.json").write_text('[{"orderId":"t1","amount":5},{"orderId":"t2","amo')
    (raw / "empty.json").write_text("")
    ingest(lake)
    assert bronze(lake) == sorted(
        [
            ("a1", 1.0, None, None), ("a2", 1.0, None, None),
            ("l1", 1.0, None, None), ("l2", 1.0, None, None),
            ("m1", 1.0, None, None), ("m2", None, '{"amount":"much"}', None),
            ("e1", 2.0, '{"unexpected":"{\\"a\\":[1,2]}"}', None),
            ("s1", 3.0, None, None),
            (None, None, None, '{"orderId": "b1", "amo'), ("b2", 4.0, None, None),
            (None, None, None, '[{"orderId":"t1","amount":5},{"orderId":"t2","amo'),
        ],
        key=repr,
    )
    ingest(lake)
    assert lake.bronze.read().count() == 11


def test_lines_layout(spark, tmp_path):
    lake = lake_at(spark, tmp_path, layout="lines")
    write_lines(tmp_path / "raw", "a.json", ['{"orderId":"a","amount":1}', "  ", "[]", "nope", '{"orderId":"b","x":null}'])
    ingest(lake)
    assert bronze(lake) == sorted(
        [
            ("a", 1.0, None, None), (None, None, None, "[]"), (None, None, None, "nope"),
            ("b", None, '{"x":null}', None),
        ],
        key=repr,
    )


def bronze_audit(lake):
    rows = lake.stage_audit().filter("stage_name = 'bronze'").orderBy("run_timestamp").collect()
    return [(r["input_records"], r["output_records"], r["details"]) for r in rows]


def test_input_of_lines_is_counted_by_the_source(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path, layout="lines", min_output_ratio=0.5), tmp_path / "raw"
    write_lines(raw, "a.json", ['{"orderId":"a","amount":1}', *["  "] * 5])
    write_lines(raw, "b.json", ['{"orderId":"b","amount":1}'])
    alerts = ingest(lake, maxFilesPerTrigger=1)
    assert [r["alert"] for r in alerts.collect()] == ["LOW_OUTPUT_RATIO"]
    write_lines(raw, "c.json", ["  ", " "])
    assert [r["alert"] for r in ingest(lake).collect()] == ["ZERO_OUTPUT"]
    assert ingest(lake).count() == 0
    assert bronze_audit(lake) == [(7, 2, "input=rows"), (2, 0, "input=rows"), (0, 0, "input=rows")]


def test_input_of_files_is_the_records_cut_from_them(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path), tmp_path / "raw"
    write_array(raw, "array.json", [(f"a{i}", "c", 1.0, "2026-01-01", "2026-01-01", 1) for i in range(5)])
    write_lines(raw, "lines.json", ['{"orderId":"l","amount":1}', "", "nope"])
    (raw / "empty.json").write_text("")
    assert ingest(lake, maxFilesPerTrigger=2).count() == 0
    (raw / "blank.json").write_text(" \n")
    ingest(lake)
    assert bronze_audit(lake) == [(7, 7, "input=records,files=2"), (0, 0, "input=records,files=1")]


def test_counting_outlives_the_list_of_progress(spark, tmp_path):
    """Each query has its own count, however many batches it takes."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        lake, raw = lake_at(spark, tmp_path, layout="lines"), tmp_path / "raw"
        for i in range(6):
            write_lines(raw, f"{i}.json", ['{"orderId":"x"}'] * (i + 1))
        ingest(lake, maxFilesPerTrigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert bronze_audit(lake) == [(21, 21, "input=rows")]


def test_json_mode_keeps_unreadable_text(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path, mode=" JSON "), tmp_path / "raw"
    row = ("x", "c", 1.0, "2026-01-01", "2026-01-01", 1)
    write_array(raw, "array.json", [("a1", *row[1:]), ("a2", *row[1:])])
    (raw / "cut.json").write_text('[{"orderId":"t1"')
    ingest(lake)
    got = bronze(lake)
    assert [g for g in got if g[3] is None] == [("a1", 1.0, None, None), ("a2", 1.0, None, None)]
    assert [g[3] for g in got if g[3]] == ['[{"orderId":"t1"']


def test_files_are_read_once_and_new_ones_are_picked_up(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path, layout="lines"), tmp_path / "raw"
    raw.mkdir()
    ingest(lake)  # an empty folder
    assert lake.bronze.read().count() == 0
    write_lines(raw, "a.json", ['{"orderId":"a"}'])
    ingest(lake)
    write_lines(raw, "b.json", ['{"orderId":"b"}'])
    ingest(lake)
    ingest(lake)
    assert rows_of(lake.bronze.read(), "orderId") == [("a",), ("b",)]
    assert [r["output_records"] for r in lake.stage_audit().orderBy("run_timestamp").collect()] == [0, 1, 1, 0]
    # a new checkpoint starts over
    again = lake_at(spark, tmp_path, layout="lines", checkpoint=str(tmp_path / "other"))
    ingest(again)
    assert again.bronze.read().count() == 4


def test_repeated_batch_is_not_appended_twice(spark, tmp_path):
    """A failure after the append and before Spark noted the batch."""
    lake = lake_at(spark, tmp_path, layout="lines")
    write_lines(tmp_path / "raw", "a.json", ['{"orderId":"a"}'])

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest(lake, then=fail)
    assert lake.bronze.read().count() == 1
    ingest(lake)
    assert lake.bronze.read().count() == 1


def test_keyed_table_follows_each_batch(spark, tmp_path):
    lake, raw = lake_at(spark, tmp_path, layout="lines"), tmp_path / "raw"
    write_lines(raw, "a.json", [("o", "c", 1.0, "2026-01-01", "2026-01-01", 1)])
    write_lines(raw, "b.json", [("o", "c", 2.0, "2026-01-01", "2026-01-02", 2)])
    follow(lake, maxFilesPerTrigger=1)
    assert rows_of(lake.silver.read(), *SILVER) == [("o", 2.0, 2)]
    assert lake.silver.snapshot().version == 2


# -- upkeep ------------------------------------------------------------------


def test_upkeep_folds_small_files_and_keeps_all_rows(spark, tmp_path):
    lake = lake_at(spark, tmp_path, production=True, retention_hours=1)
    for i, rows in enumerate((DAY_ONE, DAY_TWO)):
        put(lake, events(spark, *rows).repartition(2), f"n{i}")
        silver.process(lake)
    gold.refresh(lake)
    tables = (lake.bronze, lake.silver, lake.gold)
    before = [rows_of(t.read(), "*") for t in tables]
    upkeep.run(lake)
    assert [rows_of(t.read(), "*") for t in tables] == before
    assert len(lake.bronze.snapshot().slices) == 1
    # what was folded is still there for a reader that lags behind ...
    assert lake.bronze.written_since(0, "append").count() == 9
    # ... until it has been out of use for longer than the retention
    upkeep.run(lake, as_of=F.current_timestamp() + F.expr("INTERVAL 2 HOURS"))
    assert [rows_of(t.read(), "*") for t in tables] == before
    with pytest.raises(Exception, match="no longer has all writes"):
        lake.bronze.written_since(0, "append")
    assert silver.process(lake).count() == 0


def test_folding_the_versions_keeps_their_meaning(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    for i in range(3):
        put(lake, events(spark, *DAY_TWO), f"n{i}")
    before = rows_of(lake.bronze.versions(), "*")
    assert lake.bronze.fold_versions(above=5) == 0
    assert lake.bronze.fold_versions(above=2) == 3
    assert rows_of(lake.bronze.versions(), "*") == before
    put(lake, events(spark, *DAY_TWO), "n3")
    assert lake.bronze.snapshot().version == 4 and lake.bronze.read().count() == 8


def test_metrics_survive_lost_history(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, ("a", "c", 1.0, "2026-01-01", "2026-01-01", 1)), "one")
    silver.process(lake)
    gold.refresh(lake)
    for n, day in ((2, "2026-01-02"), (3, "2026-01-03")):
        put(lake, events(spark, ("a", "c", float(n), day, day, n)), f"n{n}", datetime(2026, 1, n))
        silver.process(lake)
    upkeep.run(lake, as_of=F.current_timestamp() + F.expr("INTERVAL 400 HOURS"))
    gold.refresh(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 1, 3), 1, 3.0)]


def test_upkeep_audit(spark, tmp_path):
    lake = lake_at(spark, tmp_path, retention_hours=12)
    rows = {r["table_name"]: r for r in upkeep.run(lake, "silver_orders", "other.orders", "default.orders;DROP_TABLE").collect()}
    assert {k: r["status"] for k, r in rows.items()} == {
        "silver_orders": "SKIPPED", "other.orders": "SKIPPED", "default.orders;DROP_TABLE": "FAILED",
    }
    assert rows["silver_orders"]["error_message"] == "Table does not exist"
    assert "trusted table identifier" in rows["default.orders;DROP_TABLE"]["error_message"]
    assert rows["default.orders;DROP_TABLE"]["error_class"] == "IllegalArgumentException"
    assert all(r["retention_policy_risk"] for r in rows.values())
    assert lake.upkeep_audit().count() == 3
    assert all(r["vacuum_retention_hours"] == 12 for r in lake.upkeep_audit().collect())
    safe = lake_at(spark, tmp_path / "b")
    row = upkeep.run(safe, "silver_orders").first()
    assert (row["retention_policy_risk"], row["audit_replay_required"], row["slow_downstream_max_lag_hours"]) == (False, True, 24)


def test_table_is_never_opened_with_another_layout(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, *DAY_TWO), "one")
    silver.process(lake)
    with pytest.raises(ValueError, match="sliced by"):
        lake_at(spark, tmp_path, slices=5).silver.read()


def test_compaction_ends(spark, tmp_path):
    lake = lake_at(spark, tmp_path, slices=2)
    rows = [(f"k{i}", f"customer {i}", i + 1.0, "2026-01-01", "2026-01-01", 1) for i in range(3000)]
    put(lake, events(spark, *rows), "one")
    silver.process(lake)
    table = lake.silver
    whole = table.read()
    table.replace(table.with_slice(whole).repartition(12))  # many small files in both slices
    sizes = {r["_slice"]: r for r in table.slice_sizes(table.snapshot()).collect()}
    assert min(r["files"] for r in sizes.values()) > 4
    target = max(r["bytes"] for r in sizes.values()) // 3
    assert compact_slices(table, target) == 3
    assert compact_slices(table, target) is None
    assert compact_slices(table) is not None and compact_slices(table) is None
    assert {r["files"] for r in table.slice_sizes(table.snapshot()).collect()} == {1}
    assert table.read().count() == 3000


def test_leftovers_of_a_dead_attempt_are_not_listed(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, *DAY_ONE), "one")
    silver.process(lake)
    table, row = lake.silver, lake.silver.read().limit(1)
    dead = table.with_slice(lake.silver.read()).withColumn("_slice", F.lit("9"))
    dead.write.partitionBy("_slice").parquet(table.folder(table.snapshot().version + 1))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        version = table.replace(row, table.snapshot().slices)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert table.snapshot().version == version and table.read().count() == 1


def test_a_run_that_lags_past_the_retention_still_gets_all_events(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    for n, day in ((1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-03")):
        put(lake, events(spark, (f"o{n}", "c", float(n), day, day, n)), f"n{n}")
    upkeep.run(lake)
    upkeep.run(lake, as_of=F.current_timestamp() + F.expr("INTERVAL 400 HOURS"))
    assert lake.bronze.versions().filter("kind = 'append'").count() == 0
    silver.process(lake)
    assert rows_of(lake.silver.read(), *SILVER) == [("o1", 1.0, 1), ("o2", 2.0, 2), ("o3", 3.0, 3)]


def test_a_batch_is_checked_once(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, *DAY_ONE), "one")
    reads = spark.sparkContext.accumulator(0)
    counting = F.udf(lambda key: reads.add(1) or key)
    bronze = lake.bronze.read().withColumn("orderId", counting("orderId"))
    silver.process_events(lake, bronze, "run", 1)
    assert reads.value == len(DAY_ONE)
    assert lake.silver.read().count() == 3


def test_metrics_under_their_old_key_and_without_marks(spark, tmp_path):
    lake = lake_at(spark, tmp_path)
    put(lake, events(spark, *DAY_ONE), "one")
    silver.process(lake)
    old = daily_metrics(lake.silver.read(), ORDER_EVENTS).withColumn("totalRevenue", F.lit(-1.0))
    old = old.withColumnRenamed("order_date", "timestamp")
    table = SlicedTable(
        spark, lake.path("gold_daily_metrics"), "`timestamp` date, totalOrders bigint, totalRevenue double",
        date_slice("timestamp"), "date",
    )
    table.replace(old)
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 5, 15), 3, -1.0)]
    gold.refresh(lake)  # no marks yet: all dates once
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 5, 15), 3, 260.5)]
    put(lake, events(spark, *DAY_TWO), "two", datetime(2026, 1, 2))
    silver.process(lake)
    gold.refresh(lake)
    assert rows_of(lake.gold.read(), *GOLD) == [(date(2026, 5, 15), 3, 275.5), (date(2026, 5, 16), 1, 25.0)]


def test_upkeep_of_plain_tables(spark, tmp_path):
    lake = lake_at(spark, tmp_path, stage_audit="stage_audit")
    for n in range(3):
        put(lake, events(spark, ("", "c", 1.0, "2026-01-01", "2026-01-01", 1)), f"n{n}")
        silver.process(lake)
    before = rows_of(lake.quarantine(), "*"), rows_of(lake.stage_audit(), "*")
    found = {r["table_name"]: r["status"] for r in upkeep.run(lake, lake.settings.quarantine, "stage_audit").collect()}
    assert set(found.values()) == {"SUCCESS"}
    assert (rows_of(lake.quarantine(), "*"), rows_of(lake.stage_audit(), "*")) == before
    assert file_sizes(spark, lake.path(lake.settings.quarantine)).count() == 1


def test_a_changed_amount_is_found_though_count_and_mark_agree(spark):
    row = ("o", "c", 1.0, datetime(2026, 1, 1), datetime(2026, 1, 1), datetime(2026, 1, 1), 1, date(2026, 1, 1))
    before = spark.createDataFrame([row], ORDER_EVENTS.state_schema)
    metrics = daily_metrics_with_mark(before, ORDER_EVENTS)
    after = before.withColumn("amount", F.lit(1.5))
    assert affected_dates(before, metrics, ORDER_EVENTS, "exact").count() == 0
    assert affected_dates(after, metrics, ORDER_EVENTS, "exact").count() == 1
