"""Arrays cut by ranges against the whole-file reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources.json_files import parse_with_rescue, split_records
from tidemark.sources.json_ranges import range_states, read_records
from tidemark.spec import CORRUPT, ORDER_EVENTS, RESCUED
from tests.helpers import rows_of

COLUMNS = ("orderId", "customerId", "amount", "timestamp", "updatedAt", "eventVersion", RESCUED, CORRUPT)


def by_ranges(spark, folder, size):
    """Events read in ranges of ``size`` bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        paths = [str(p) for p in sorted(folder.iterdir())]
        states = range_states(spark, paths).collect()
        return states, rows_of(parse_with_rescue(read_records(spark, paths), ORDER_EVENTS), *COLUMNS)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def as_wholes(spark, folder):
    texts = spark.read.text(str(folder), wholetext=True)
    return rows_of(parse_with_rescue(split_records(texts, "value"), ORDER_EVENTS), *COLUMNS)


def order(pick, i):
    strange = ['"', "\\", "}", "{", "[", "]", ",", "\\\"", "é日", "\n", "x" * pick.choice([1, 300]), "}{\"", "\\u0041"]
    found = {
        "orderId": f"o{i}", "customerId": "".join(pick.choices(strange, k=3)), "amount": pick.choice([1, 2.5, 1e20, -3, None]),
        "timestamp": "2026-01-01", "eventVersion": pick.choice([1, 2, "much"]),
    }
    if pick.random() < 0.3:
        found["extra"] = {"a": [1, {"b": "}]"}, []], "c": {}}
    return found


@pytest.mark.parametrize("size", [150, 3000])
def test_array_of_many_ranges_equals_the_whole_file(spark, tmp_path, size):
    pick = random.Random(size)
    for n, indent in enumerate([None, 2]):
        orders = [order(pick, i) for i in range(pick.choice([40, 60]))]
        orders[3:3] = [None, 7, "te\"xt, ]", [1, 2, {"a": "}"}], {}, True]
        (tmp_path / f"a{n}.json").write_text("\ufeff" * n + json.dumps(orders, indent=indent, ensure_ascii=bool(n)) + "\n" * n)
    (tmp_path / "one long.json").write_text(json.dumps([{"orderId": "long", "customerId": "}" * 2000, "deep": [{"a": {}}] * 100}]))
    states, found = by_ranges(spark, tmp_path, size)
    assert {s["kind"] for s in states} == {"array"} and len(states) > (20 if size < 1000 else 2)
    assert found == as_wholes(spark, tmp_path)


def test_other_kinds_of_files(spark, tmp_path):
    texts = {
        "empty": "", "blank": " \n\n", "none": "[]", "nothing": " [ ] \n", "lines": '{"orderId":"a"}\n\n{"orderId":"b","x":{"y":1}}\nnope\n{"orderId":"c"}',
        "object": '{\n "orderId": "o",\n "amount": 3\n}', "cut": '[{"orderId":"t1"},{"orderId":"t2","amo', "text": '[{"orderId":"x]', "open": '[{"orderId":"x"}',
        "first broken": '{"orderId": "b1", "amo\n{"orderId":"b2","amount":4}', "one": '{"orderId":"single"}', "number": "12", "word": "nope",
        "nested": '{"orderId":{"a":1}}\n', "too much": '[{"orderId":"x"}]]',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    states, found = by_ranges(spark, tmp_path, 1 << 20)
    kinds = {s["file"].rsplit("/", 1)[1].removesuffix(".json").replace("%20", " "): s["kind"] for s in states}
    assert kinds["lines"] == kinds["one"] == "lines" and kinds["object"] == kinds["cut"] == kinds["too much"] == "whole" and kinds["none"] == "array"
    assert found == as_wholes(spark, tmp_path)


def test_unreadable_element_is_corrupt_on_its_own(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"orderId":"a"}, {"orderId":tru}, {"orderId":"b"}]')
    _, found = by_ranges(spark, tmp_path, 1 << 20)
    assert [(r[0], r[7]) for r in found] == sorted([("a", None), ("b", None), (None, '{"orderId":tru}')], key=repr)


def test_compressed_array_is_one_range(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(json.dumps([{"orderId": f"o{i}"} for i in range(500)]).encode()))
    states, found = by_ranges(spark, tmp_path, 100)
    assert len(states) == 1 and len(found) == 500


def test_no_files(spark):
    assert read_records(spark, []).collect() == []
