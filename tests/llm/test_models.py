"""The two trained operators: held-out accuracy, gradients, folds and edge rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ROWS, clashing, empty
from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_documents(spark):
    docs, labels = tables(spark)
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = big[1].filter("pmod(xxhash64(doc_id), 4) <> 0")
    chain = toxicity.train(toxicity.labelled(big[0], known), (*toxicity.SEEDS, "toxic"))
    held = big[1].filter("pmod(xxhash64(doc_id), 4) = 0").withColumnRenamed("toxic", "label")
    scored = toxicity.score(big[0].join(held, "doc_id", "left_semi"), chain).join(held, "doc_id")
    n = {(r.label, r.toxic): r["count"] for r in scored.groupBy("label", "toxic").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01
    # later models lean on earlier ones, and no model on itself or a later one
    assert np.abs(np.tril(chain.earlier, -1)).sum() > 0 and np.triu(chain.earlier).sum() == 0
    kept = toxicity.drop_toxic(big[0], chain)
    gone = big[0].count() - kept.count()
    assert kept.columns == big[0].columns and gone == toxicity.score(big[0], chain).filter("toxic = 1").count()


def test_out_of_fold_probabilities_do_not_leak():
    random = np.random.default_rng(0)
    labels = np.column_stack([random.integers(0, 2, 200)] * 2).astype(float)
    # each row has a feature of its own: a model that saw the row could repeat its label
    _, _, chain = toxicity.fit_chain([[i] for i in range(200)], labels, 200)
    assert abs(chain[1, 0]) < 3


def test_chain_edges(spark):
    docs, labels = tables(spark)
    none = toxicity.train(toxicity.labelled(docs, labels.limit(0)), (*toxicity.SEEDS, "toxic"))
    odd = clashing(spark, "toxic", "held", "p_toxic")
    scored = toxicity.score(odd, none).collect()
    assert len(scored) == len(ROWS) and not any(r.toxic for r in scored)
    assert toxicity.drop_toxic(odd, none).columns == odd.columns
    assert toxicity.score(empty(spark), none).collect() == []
    same = labels.withColumn("toxic", F.lit(0))
    clean = toxicity.train(toxicity.labelled(docs, same, rows=50), (*toxicity.SEEDS, "toxic"))
    assert toxicity.score(docs, clean).filter("toxic = 1").count() == 0
    nulls = labels.withColumn("toxic", F.lit(None).cast("int")).unionAll(labels.withColumn("doc_id", F.lit(None).cast("long")))
    assert toxicity.labelled(docs, nulls).count() == 0


def test_gradients_match_differences():
    random = np.random.default_rng(0)
    model = {k: random.normal(0, 0.3, s) for k, s in quality.SHAPES.items()}
    x, starts, y = random.random((9, quality.INPUTS)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = quality.forward(model, x, starts)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = quality.gradients(model, x, starts, y)
    for name, values in model.items():
        at = tuple(0 for _ in values.shape)
        before = values[at]
        values[at] = before + 1e-5
        up = loss()
        values[at] = before - 1e-5
        down = loss()
        values[at] = before
        assert abs(found[name][at] - (up - down) / 2e-5) < 1e-7, name


def test_attention_weighs_passages_of_one_document():
    random = np.random.default_rng(0)
    model = {k: random.normal(0, 0.3, s) for k, s in quality.SHAPES.items()}
    _, (_, _, _, _, alpha, _) = quality.forward(model, random.random((7, quality.INPUTS)), np.array([0, 3]))
    assert np.allclose([alpha[:3].sum(), alpha[3:].sum()], 1)


def test_quality_on_held_out_documents(spark):
    docs, labels = tables(spark)
    docs = docs.withColumns({"quality": F.lit("x"), "score": F.lit(1)})
    found = quality.quality_report(docs, labels).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    scored = [(r.score, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in scored if y], [s for s, y in scored if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.9


def test_held_out_labels_teach_nothing(spark):
    docs, labels = tables(spark)
    changed = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.train(docs, labels, rows=60), quality.train(docs, changed, rows=60)
    assert all((one[k] == two[k]).all() for k in one)


def test_quality_edges(spark):
    docs, labels = tables(spark)
    model = quality.train(docs, labels.limit(0))
    found = quality.score(clashing(spark, "score", "held_out"), model).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    assert quality.score(empty(spark), model).collect() == []
    assert len(quality.passages("x" * 10_000_00)) <= quality.PASSAGES
    assert quality.passages("").shape == (1, quality.INPUTS)


def test_every_passage_of_a_long_text_counts():
    words = [f"word{i * 7919 % 1009}" for i in range(60_000)]
    text = "".join(w + (" " if i % 3 else "  \n") for i, w in enumerate(words)) + "again " * 90
    found = np.concatenate(list(quality.chunks(text)))
    raw = text.encode()
    assert len(found) == -(-len(raw) // quality.PASSAGE_BYTES) > quality.PASSAGES
    for i in (0, 255, 256, 600, len(found) - 1):
        part = raw[512 * i:512 * i + 512]
        counts = np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        assert np.allclose(found[i, :256], np.sqrt(counts / len(part))) and np.isclose(found[i, 258], np.log1p(len(part)) / 8)
    before, quality.STRETCH = quality.STRETCH, 1000
    try:
        assert (np.concatenate(list(quality.chunks(text))) == found).all()
    finally:
        quality.STRETCH = before
    model = {k: np.random.default_rng(0).normal(0, 0.3, s) for k, s in quality.SHAPES.items()}
    values = ["short", text, "", "x" * 512 * 256, "x" * (512 * 256 + 1)]
    bags = [np.concatenate(list(quality.chunks(v))) for v in values]
    whole = quality.forward(model, np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])]))[0]
    for at_once in (1, 2, 256):
        assert np.allclose(quality.score_texts(model, values, at_once), whole, atol=1e-6)


def test_gradients_of_long_bags_match_those_of_whole_ones():
    random = np.random.default_rng(0)
    model = {k: random.normal(0, 0.3, s) for k, s in quality.SHAPES.items()}
    bags, y = [random.random((n, quality.INPUTS)) for n in (1, 9, 4, 30)], np.array([1.0, 0.0, 1.0, 0.0])
    whole = quality.gradients(model, np.concatenate(bags), np.array([0, 1, 10, 14]), y)
    for size, at_once in ((4, 2), (3, 1), (100, 64)):
        found = quality.bag_gradients(model, bags, y, size, at_once)
        assert all(np.allclose(found[k], whole[k]) for k in quality.SHAPES)
