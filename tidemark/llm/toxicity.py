"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models.  Each model sees the words of the text and the
probabilities of the categories before its own.  For training those are out of fold: each comes
from a model that has not seen the document, so a later model learns how far an earlier one can be trusted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import texts, workers_import
from tidemark.llm.encoding import release
from tidemark.session import keep

#: Bounds of training: labelled documents it may use, and words or beginnings of words a model may weigh.
TRAIN_ROWS, FEATURES = 8_000, 1_536
FOLDS, LEAST_DOCUMENTS = 5, 4
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.3
#: Weak categories of the one label there is: toxic texts that have one of these words.
SEEDS = {
    "insult": ("idiot", "moron", "loser", "clown", "stupid"),
    "contempt": ("scum", "trash", "worthless", "pathetic", "disgusting"),
}
_SPLIT = bytes.maketrans(bytes(i for i in range(128) if not chr(i).isalnum()), b" " * sum(not chr(i).isalnum() for i in range(128)))


def features(text: str) -> set[bytes]:
    """Distinct words of the whole text, lower case, and their beginnings (marked by ``^``)."""
    words = set(text.lower().encode().translate(_SPLIT).split())
    found = set(words)
    for n in PREFIXES:
        found.update([b"^" + w[:n] for w in words if len(w) > n])
    return found


@dataclass(frozen=True)
class Chain:
    """A trained chain: ``place`` of each feature, and for each category its bias, feature and chain weights."""

    categories: tuple[str, ...]
    place: dict[bytes, int]
    bias: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray

    def probabilities(self, text: str) -> list[float]:
        held = [self.place[f] for f in features(text) & self.place.keys()]
        found: list[float] = []
        for k in range(len(self.categories)):
            score = self.bias[k] + self.weights[k, held].sum() + self.earlier[k, :k] @ np.array(found)
            found.append(float(1 / (1 + np.exp(-np.clip(score, -60, 60)))))
        return found


def _solve(times, b: np.ndarray, scale: np.ndarray, steps: int = 40) -> np.ndarray:
    """Conjugate gradients for the symmetric map ``times``, scaled by its diagonal."""
    x, r = np.zeros_like(b), b.copy()
    d = z = r / scale
    size = r @ z
    for _ in range(steps):
        if size < 1e-10:
            break
        td = times(d)
        x, r = x + (size / (d @ td)) * d, r - (size / (d @ td)) * td
        z = r / scale
        size, before = r @ z, size
        d = z + (size / before) * d
    return x


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.5, steps: int = 10) -> np.ndarray:
    """Bias and weights of a logistic regression, by Newton steps."""
    if y.min(initial=1) == y.max(initial=0):
        prior = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
        return np.concatenate([[np.log(prior / (1 - prior))], np.zeros(x.shape[1])])
    x = np.column_stack([np.ones(len(x), np.float32), x.astype(np.float32)])
    ridge = np.full(x.shape[1], penalty, np.float32)
    ridge[0] = 1e-6
    w = np.zeros(x.shape[1], np.float32)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        step = _solve(lambda v: x.T @ (curve * (x @ v)) + ridge * v, x.T @ (y.astype(np.float32) - p) - ridge * w, curve @ (x * x) + ridge)
        w += step * min(1.0, 8 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w.astype(float)


def fit_chain(held: list[list[int]], labels: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bias, feature weights and chain weights; ``labels`` has a column per category, in chain order."""
    rows, n = labels.shape
    x = np.zeros((rows, n_features), np.float32)
    for i, at in enumerate(held):
        x[i, at] = 1.0
    fold = np.arange(rows) % FOLDS
    earlier = np.zeros((rows, 0))
    bias, weights, chain = np.zeros(n), np.zeros((n, n_features)), np.zeros((n, n))
    for k in range(n):
        seen = np.column_stack([x, earlier])
        w = _fit(seen, labels[:, k])
        bias[k], weights[k], chain[k, :k] = w[0], w[1:n_features + 1], w[n_features + 1:]
        apart = np.zeros(rows)
        for f in range(FOLDS) if k < n - 1 else ():
            out = _fit(seen[fold != f], labels[fold != f, k])
            apart[fold == f] = 1 / (1 + np.exp(-np.clip(out[0] + seen[fold == f] @ out[1:], -60, 60)))
        earlier = np.column_stack([earlier, apart])
    return bias, weights, chain


def labelled(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seeds: dict[str, tuple[str, ...]] = SEEDS) -> DataFrame:
    """At most ``rows`` labelled documents, chosen by a hash of their id: ``doc_id, text``, a 0/1 column per category.

    The last category is the label ``toxic``; each earlier one is a toxic text with one of its seed words.
    """
    chosen = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("double").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
    found = texts(documents).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    has = lambda words: F.col("text").rlike(r"(?i)\b(?:" + "|".join(words) + r")\b").cast("double")
    return found.select("doc_id", "text", *((F.col("toxic") * has(w)).alias(c) for c, w in seeds.items()), "toxic")


def train(examples: DataFrame, categories: tuple[str, ...], n_features: int = FEATURES) -> Chain:
    """A chain fitted to ``examples`` (``doc_id, text`` and a 0/1 column per category, in chain order).

    ``examples`` must be bounded; its texts never leave their tasks, which hand on counts of features
    and, for the features chosen, one short list per document.
    """
    workers_import(examples.sparkSession)
    examples = keep(examples, "examples")
    last = categories[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_, with_ = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column(last).to_pylist()):
                found = features(text)
                all_.update(found)
                if label:
                    with_.update(found)
        names = list(all_)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([all_[f] for f in names], pa.int64()), pa.array([with_[f] for f in names], pa.int64())],
            names=["feature", "n", "n_with"],
        )

    size = examples.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(last), F.lit(0.0)).alias("n_with")).first()
    if not size["n"]:
        n = len(categories)
        return Chain(categories, {}, np.full(n, -9.0), np.zeros((n, 0)), np.zeros((n, n)))
    counts = examples.select("text", last).mapInArrow(count, "feature binary, n long, n_with long")
    share = size["n_with"] / size["n"]
    off = F.abs(F.col("n_with") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share) + 1e-9))
    chosen = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_with").alias("n_with")).filter(F.col("n") >= LEAST_DOCUMENTS)
    top = chosen.orderBy(off.desc(), "feature").limit(n_features).collect()
    place = {bytes(r["feature"]): i for i, r in enumerate(top)}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(place[f] for f in features(t) & place.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), *(batch.column(c) for c in ("doc_id", *categories))], names=["held", "doc_id", *categories])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("doc_id")
        labels = np.column_stack([table[c].to_numpy() for c in categories])
        bias, weights, chain = fit_chain(table["held"].to_pylist(), labels, len(place))
        yield pa.RecordBatch.from_arrays([pa.array([x.ravel().tolist()]) for x in (bias, weights, chain)], names=["bias", "weights", "earlier"])

    kinds = ", ".join(f"{c} double" for c in categories)
    rows = examples.mapInArrow(hold, f"held array<int>, doc_id long, {kinds}").coalesce(1)
    model = rows.mapInArrow(fit, "bias array<double>, weights array<double>, earlier array<double>").first()
    n = len(categories)
    return Chain(categories, place, np.array(model["bias"]), np.array(model["weights"]).reshape(n, -1), np.array(model["earlier"]).reshape(n, n))


def score(documents: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, a probability ``p_<category>`` for each category, and ``toxic`` for every row.

    ``toxic`` is 1 where the last category is at least ``threshold``.  A null or empty text has no words and
    gets the probabilities of that.  Repeated rows each get a row; other columns are not read.
    """
    workers_import(documents.sparkSession)
    columns = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([chain.probabilities(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(columns))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in found.T)], names=["doc_id", *columns])

    scored = texts(documents).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in columns))
    return scored.withColumn("toxic", (F.col(columns[-1]) >= threshold).cast("int"))


def _toxic(text: Column, chain: Chain, threshold: float) -> Column:
    @F.arrow_udf("boolean")
    def run(values: pa.Array) -> pa.Array:
        release()
        return pa.array([bool(chain.probabilities(t.as_py())[-1] >= threshold) for t in values], pa.bool_())

    return run(F.coalesce(text, F.lit("")))


def drop_toxic(documents: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without the rows that :func:`score` calls toxic; columns come through unchanged."""
    workers_import(documents.sparkSession)
    return documents.filter(~_toxic(F.col("text"), chain, threshold))


def toxicity_report(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Train on at most ``train_rows`` labelled documents and :func:`score` all."""
    return score(documents, train(labelled(documents, labels, train_rows), (*SEEDS, "toxic")), threshold)
