"""The registered queries and the stages of the corpus pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, difference
from tests.llm.helpers import documents, empty
from tidemark.llm import oracles, queries
from tidemark.session import keep

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{n}" for n in range(1, 14)]
    assert {*names, "pipeline"} <= set(entry.queries())
    assert set(oracles.oracles()) <= set(names) and not [n for n in names if n in entry.oracle_sql() and n not in oracles.oracles()]


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_against_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, queries.queries()[name], oracles.oracles()[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    start, before = docs.columns, docs.count()
    rows = []
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), "stage")
        rows.append(docs.count())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == start
    toxic, exact, near, _, _ = rows
    assert before > toxic > exact >= near
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 2048").count() == 0


@pytest.mark.parametrize("make", [documents, empty])
def test_stages_take_any_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), "stage")
    assert docs.columns[:2] == ["doc_id", "piece"]
