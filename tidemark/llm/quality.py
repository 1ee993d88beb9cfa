"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label.  Each passage is encoded, a gated attention
weighs the codes within their document, and the weighted sum is scored.  Encoder, attention and
score are learned together from document labels, so the weights show which passages decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import texts, workers_import
from tidemark.session import keep

#: Bound of training, and the passages that are encoded together: a longer text takes several such chunks.
TRAIN_ROWS, PASSAGES = 8_000, 256
PASSAGE_BYTES = 512
#: Bytes whose words are compared together, to the next blank.
STRETCH, BLANK = 1 << 20, re.compile(rb"[ \t\n\r\x0b\x0c]")
TRIGRAMS = 1_024
WIDTH, ATTENTION = 24, 12
EPOCHS, BAGS, RATE = 12, 64, 0.004
THRESHOLD = 0.3
FOLDS = 5


def _repeats(raw: bytes, n: int) -> np.ndarray:
    """Share of the words beginning in each of ``n`` passages that repeat the one before, a stretch of text at a time."""
    words_in, repeats_in = np.zeros(n), np.zeros(n)
    start, at, last = 0, 0, []
    while start < len(raw):
        cut = BLANK.search(raw, start + STRETCH)
        end = cut.start() if cut else len(raw)
        words = last + raw[start:end].split()
        if words:
            places = at + np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)[:-1]
            of = np.minimum(places // PASSAGE_BYTES, n - 1)
            again = np.fromiter(map(eq, words[1:], words), bool, len(words) - 1)
            words_in += np.bincount(of, minlength=n)
            repeats_in += np.bincount(of, weights=again, minlength=n)
            at, last = int(places[-1]) if len(places) else at, words[-1:]
        start = end
    return repeats_in / np.maximum(1, words_in)


def passages(text: str | bytes, first: int = 0, repeats: np.ndarray | None = None) -> np.ndarray:
    """One row per passage of 512 bytes, of the at most ``PASSAGES`` from number ``first`` on; :func:`chunks` gives all.

    How often each byte occurs, how varied its trigrams are, how many words repeat the one before, its length.
    """
    raw = (text.encode() if isinstance(text, str) else text) or b" "
    if repeats is None:
        repeats = _repeats(raw, -(-len(raw) // PASSAGE_BYTES))
    start, end = first * PASSAGE_BYTES, (first + PASSAGES) * PASSAGE_BYTES
    data = np.frombuffer(raw[start:end], np.uint8)
    n = -(-len(data) // PASSAGE_BYTES)
    of = np.arange(len(data)) // PASSAGE_BYTES
    lengths = np.bincount(of, minlength=n)[:, None]
    found = np.bincount(of * 256 + data, minlength=n * 256).reshape(n, 256)
    wide = np.frombuffer(raw[start:end + 2], np.uint8).astype(np.int64)
    trigram = (wide[:-2] * 31 + wide[1:-1] * 7 + wide[2:] * 131) % TRIGRAMS if len(wide) > 2 else wide[:0]
    kinds = np.bincount(of[: len(trigram)] * TRIGRAMS + trigram, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS) > 0
    varied = kinds.sum(axis=1, keepdims=True) / np.minimum(lengths, TRIGRAMS)
    return np.hstack([np.sqrt(found / lengths), 2 * varied, 2 * repeats[first:first + n, None], np.log1p(lengths) / 8]).astype(np.float32)


def chunks(text: str) -> Iterator[np.ndarray]:
    """All passages of the text, however long, ``PASSAGES`` at a time."""
    raw = text.encode() or b" "
    repeats = _repeats(raw, -(-len(raw) // PASSAGE_BYTES))
    for first in range(0, len(repeats), PASSAGES):
        yield passages(raw, first, repeats)


INPUTS = 259
SHAPES = {"W": (INPUTS, WIDTH), "b": (WIDTH,), "V": (WIDTH, ATTENTION), "U": (WIDTH, ATTENTION), "a": (ATTENTION,), "c": (WIDTH,), "d": (1,)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def pool(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    """Attention over the rows of ``x`` from each of ``starts`` on: codes, weights, weighted sums, and what :func:`merge` needs."""
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    s = (t * g) @ m["a"]
    top = np.maximum.reduceat(s, starts)
    e = np.exp(s - np.repeat(top, sizes))
    total = np.add.reduceat(e, starts)
    alpha = e / np.repeat(total, sizes)
    z = np.add.reduceat(alpha[:, None] * h, starts)
    return (sizes, h, t, g, alpha, z), top, total


def merge(top: np.ndarray, total: np.ndarray, z: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sum of each document from those of its chunks, and the weight of each chunk: the softmax over all passages.

    ``top`` and ``total`` are a chunk's largest attention score and the sum of its weights relative to that.
    """
    sizes = np.diff(np.append(starts, len(top)))
    share = total * np.exp(top - np.repeat(np.maximum.reduceat(top, starts), sizes))
    share = share / np.repeat(np.add.reduceat(share, starts), sizes)
    return np.add.reduceat(share[:, None] * z, starts), share


def _out(m: dict[str, np.ndarray], z: np.ndarray) -> np.ndarray:
    return _sigmoid(z @ m["c"] + m["d"][0])


def forward(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    """Score of each bag; bag ``i`` has the rows of ``x`` from ``starts[i]`` on.  Also all steps on the way."""
    steps, _, _ = pool(m, x, starts)
    return _out(m, steps[-1]), steps


def _back(m: dict[str, np.ndarray], x: np.ndarray, steps: tuple, share: np.ndarray, z: np.ndarray, dout: np.ndarray) -> dict[str, np.ndarray]:
    """What chunks of passages add to the gradients of all but the score's layer.

    ``share, z, dout``: for each chunk its weight in its document, the document's weighted sum and the loss's slope.
    """
    sizes, h, t, g, alpha, _ = steps
    alpha = alpha * np.repeat(share, sizes)
    dz = np.repeat(dout, sizes)[:, None] * m["c"]
    ds = alpha * ((dz * h).sum(axis=1) - np.repeat(dout * (z @ m["c"]), sizes))
    dt, dg = ds[:, None] * m["a"] * g * (1 - t * t), ds[:, None] * m["a"] * t * g * (1 - g)
    dh = (alpha[:, None] * dz + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ ds}


def gradients(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss over the bags."""
    bags = np.split(x, starts[1:])
    return bag_gradients(m, bags, y, max(map(len, bags)), len(bags))


def _blocks(bags: list[np.ndarray], size: int, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bags in chunks of ``size`` rows, ``at_once`` chunks together: rows, where chunks start, the bag of each chunk."""
    places = [(i, at) for i, bag in enumerate(bags) for at in range(0, len(bag), size)]
    for k in range(0, len(places), at_once):
        part = [bags[i][at:at + size] for i, at in places[k:k + at_once]]
        x = np.concatenate(part)
        yield x.astype(np.result_type(x, np.float32), copy=False), np.cumsum([0, *map(len, part[:-1])]), np.array([i for i, _ in places[k:k + at_once]])


def bag_gradients(m: dict[str, np.ndarray], bags: list[np.ndarray], y: np.ndarray, size: int = PASSAGES, at_once: int = BAGS) -> dict[str, np.ndarray]:
    """:func:`gradients` over whole bags of any length; no more than ``at_once`` chunks of ``size`` passages are encoded together."""
    pooled, of, kept = [], [], None
    for x, starts, owners in _blocks(bags, size, at_once):
        kept = pool(m, x, starts)
        pooled.append((kept[1], kept[2], kept[0][-1]))
        of.append(owners)
    of = np.concatenate(of)
    z, share = merge(*map(np.concatenate, zip(*pooled)), np.searchsorted(of, np.arange(len(bags))))
    dout = (_out(m, z) - y) / len(y)
    total, at = {"c": z.T @ dout, "d": np.array([dout.sum()])}, 0
    for x, starts, owners in _blocks(bags, size, at_once):
        steps = kept[0] if len(pooled) == 1 else pool(m, x, starts)[0]
        for k, v in _back(m, x, steps, share[at:at + len(owners)], z[owners], dout[owners]).items():
            total[k] = total[k] + v if k in total else v
        at += len(owners)
    return total


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam over shuffled batches of bags; the same bags in the same order give the same model."""
    random = np.random.default_rng(seed)
    model = {k: (random.normal(0, 1 / np.sqrt(s[0]), s) * (k not in "bd")).astype(np.float32) for k, s in SHAPES.items()}
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    model["d"][0] = np.log(share / (1 - share))
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second, step = {k: np.zeros_like(v) for k, v in model.items()}, 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(order), BAGS):
            chosen = order[at:at + BAGS]
            step += 1
            for k, d in bag_gradients(model, [bags[i] for i in chosen], labels[chosen]).items():
                d = d + 1e-4 * model[k] * (k not in "bd")
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model[k] = (model[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """A model fitted to at most ``rows`` labelled documents that are not held out, chosen by a hash of their id.

    The documents' whole texts are turned into passages where they are read; one task learns from the bags, which are
    about as large as the texts.
    """
    workers_import(documents.sparkSession)
    chosen = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    chosen = chosen.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min("quality").cast("double").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
    examples = texts(documents).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    examples = keep(examples.select("doc_id", "text", "quality"), "examples")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [b"".join(c.astype(np.float16).tobytes() for c in chunks(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(bags, pa.binary())], names=["doc_id", "quality", "bag"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r["doc_id"], r["quality"], r["bag"]) for b in batches for r in b.to_pylist())
        bags = [np.frombuffer(b, np.float16).reshape(-1, INPUTS) for _, _, b in found]
        model = fit(bags, np.array([q for _, q, _ in found], np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([k for k in SHAPES]), pa.array([model[k].ravel().tolist() for k in SHAPES])], names=["name", "values"])

    encoded = examples.mapInArrow(encode, "doc_id long, quality double, bag binary").coalesce(1)
    model = {r["name"]: r["values"] for r in encoded.mapInArrow(learn, "name string, values array<double>").collect()}
    if not model:
        model = {k: v.ravel().tolist() for k, v in fit([], np.zeros(0)).items()}
    return {k: np.array(model[k], np.float32).reshape(s) for k, s in SHAPES.items()}


def score_texts(model: dict[str, np.ndarray], values: list[str], at_once: int = 256) -> np.ndarray:
    """Scores from all passages of each text; no more than ``at_once`` chunks are encoded together."""
    pooled, of, waiting = [], [], []

    def encode():
        (*_, z), top, total = pool(model, np.concatenate(waiting), np.cumsum([0, *map(len, waiting[:-1])]))
        pooled.append((top, total, z))
        waiting.clear()

    for i, text in enumerate(values):
        for chunk in chunks(text):
            waiting.append(chunk)
            of.append(i)
            if len(waiting) == at_once:
                encode()
    if waiting:
        encode()
    if not of:
        return np.zeros(0)
    return _out(model, merge(*map(np.concatenate, zip(*pooled)), np.searchsorted(of, np.arange(len(values))))[0])


def score(documents: DataFrame, model: dict[str, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``predicted`` is 1 from ``threshold`` on.

    Scores depend on the text only.  A null or empty text is one passage holding a blank.  Repeated rows each
    get a row; other columns are not read.
    """
    workers_import(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = score_texts(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.astype(float))], names=["doc_id", "score"])

    scored = texts(documents).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_report(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Train on at most ``train_rows`` labelled documents that are not held out, and :func:`score` all."""
    return score(documents, train(documents, labels, train_rows), threshold)
