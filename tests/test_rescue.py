"""Records that need no second parse, against parsing every record by name."""

from pyspark.sql import functions as F

from tests.helpers import rows_of
from tidemark.sources.json_files import parse_with_rescue
from tidemark.sources.json_ranges import read_records
from tidemark.spec import CORRUPT, ORDER_EVENTS, RESCUED

RECORDS = [
    '{"orderId":"a","amount":1.5,"eventVersion":2}', '{"orderId":"a","amount":null}', '{"orderId":"a","amount":"x"}', '{}', ' { } ', "null", "",
    '{"orderId":"a","more":1}', '{"orderId":1.10,"customerId":{"b": [1, 2]}}', '{"eventVersion":1e2}', '{"eventVersion":3.0,"orderId":"q"}',
    '{"orderId":"a"} and more', '{"orderId":"a"}{"orderId":"b"}', '[{"orderId":"a"}]', '{"orderId":"a"', '{"orderId":"a",}', "{'orderId':'a'}",
    '{"orderId":"a\\q"}', '{"orderId":"a","orderId":"b"}', '{"amount":"x","amount":5}', '{"amount":5,"amount":"x"}', '{"ORDERID":"a"}',
    '{"order\\u0049d":"a"}', '{"orderId":"\\u00e9\\n"}', '{"":1}', "7", '"text"', "tru", '{"orderId":tru}', '{"amount":NaN,"orderId":true}',
]


def by_name(records):
    """Every record parsed twice, as all were once."""
    known = list(ORDER_EVENTS.raw)
    parsed = records.select(
        "record", F.from_json("record", ORDER_EVENTS.raw_schema).alias("typed"), F.from_json("record", "map<string,string>").alias("found"))
    read = F.array_compact(F.array(*[F.when(F.col(f"typed.`{c}`").isNotNull(), F.lit(c)) for c in known]))
    left = F.map_filter("found", lambda k, v: ~k.isin(known) | (v.isNotNull() & ~F.array_contains("read", k)))
    return parsed.withColumn("read", read).withColumn("left", left).select(
        "record", *[F.col(f"typed.`{c}`").alias(c) for c in known],
        F.when(F.size("left") > 0, F.to_json("left")).alias(RESCUED), F.when(F.col("found").isNull(), F.col("record")).alias(CORRUPT))


def test_every_record_comes_out_as_if_parsed_by_name(spark):
    records = spark.createDataFrame([(r,) for r in RECORDS], "record string").repartition(1)
    got, want = rows_of(parse_with_rescue(records, ORDER_EVENTS), "*"), rows_of(by_name(records).drop("record"), "*")
    assert len(got) == len(RECORDS) and len(got[0]) == len(ORDER_EVENTS.raw) + 2
    assert repr(got) == repr(want)


def test_objects_of_an_array_are_not_written_anew(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"orderId": "a"}, {"orderId": {"b": 1}},\n [1, 2], "te\\"xt", null, {"x": tru}]')
    found = [r[0] for r in rows_of(read_records(spark, [str(tmp_path / "a.json")]), "record")]
    assert sorted(found) == sorted(['{"orderId": "a"}', '{"orderId": {"b": 1}}', "[1,2]", 'te"xt', "null", '{"x": tru}'])
